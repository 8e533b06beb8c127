"""WL-MATCH and WL-EXTRACT queries.

Stand-ins (FIXTURES part 3), all derived from the whole tables:

* onboarding addresses: one row per customer, from customer ⋈ nation ⋈
  region, with blanks and case changes; a negative balance gives an empty
  street (no candidate), a balance in [0, 200) an unusable zip (partial);
  segment = market segment, advertiser = region name.
* address master: standard form of the addresses of customers outside the
  AUTOMOBILE segment, id encrypted.
* partner map: customers with balance > 1000; partner activity: one row per
  order (flag Y for open orders); customer-id map: nations 0..19; IP
  history: one row per order (ip text from the order key, modified at the
  order date).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.scalars import decrypt_id, encrypt_id, hash_ip, lower_trim
from kestrel.operators import extracts, matching
from kestrel.plans.registry import query
from kestrel.session import Scope, scratch_path
from kestrel.sinks import writers
from kestrel.sources.tables import Tables

# Cipher key of the fixtures, derived from a label (a real job reads its key
# from its secret store and passes it in).
FIXTURE_KEY = hashlib.sha256(b"kestrel fixture id cipher").hexdigest()[:16]
IP_SALT = "kestrel-salt:"
FILE_DAY = dt.date(2024, 1, 1)


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def ip_text(key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.concat_ws(".", F.lit("10"), _s(F.floor(k / 65536) % 256), _s(F.floor(k / 256) % 256), _s(k % 256))


def onboarding(t: Tables) -> DataFrame:
    c, n, r = t.customer, t.nation, t.region
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    seg, adv = F.lower("c_mktsegment"), F.lower("r_name")
    return j.select(
        seg.alias("segment_name"), adv.alias("advertiser_name"),
        F.concat(seg, F.lit("_"), adv, F.lit(f"_{FILE_DAY:%Y%m%d}.csv")).alias("file_name"),
        F.when(F.col("c_acctbal") < 0, F.lit("   "))
        .otherwise(F.concat(F.lit(" "), _s("c_custkey"), F.lit("  "), F.lower("n_name"), F.lit(" St ")))
        .alias("address"),
        F.concat(F.lit(" "), F.col("n_name")).alias("city"),
        F.col("r_name").alias("state"),
        F.when((F.col("c_acctbal") >= 0) & (F.col("c_acctbal") < 200), F.lit("n/a"))
        .otherwise(_s(F.col("c_nationkey") * 37 + 10000)).alias("zip"))


def address_master(t: Tables) -> DataFrame:
    c, n, r = t.customer, t.nation, t.region
    j = (c.filter(F.col("c_mktsegment") != "AUTOMOBILE").join(n, c.c_nationkey == n.n_nationkey)
         .join(r, n.n_regionkey == r.r_regionkey))
    return j.select(
        F.concat(_s("c_custkey"), F.lit(" "), F.col("n_name"), F.lit(" STREET")).alias("standard_delivery_line_1"),
        F.lit(None).cast("string").alias("standard_delivery_line_2"),
        _s(F.col("c_nationkey") * 37 + 10000).alias("standard_zipcode"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("standard_city"),
        F.col("r_name").alias("standard_state"),
        encrypt_id(F.concat(F.lit("u"), _s("c_custkey")), FIXTURE_KEY).alias("enc_uhid"))


def partner_map(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_acctbal") > 1000).select(
        F.concat(F.lit("n"), _s("c_custkey")).alias("nu_uhid"), F.concat(F.lit("u"), _s("c_custkey")).alias("uhid"))


def partner_activity(t: Tables) -> DataFrame:
    return t.orders.select(F.concat(F.lit("n"), _s("o_custkey")).alias("custid"),
                           F.when(F.col("o_orderstatus") == "O", "Y").otherwise("N").alias("dsp_flag"))


def customer_id_map(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_nationkey") < 20).select(
        F.concat(F.lit("c"), _s("c_custkey")).alias("cuhid"), F.concat(F.lit("u"), _s("c_custkey")).alias("uhid"))


def ip_history(t: Tables) -> DataFrame:
    return t.orders.select(F.concat(F.lit("c"), _s("o_custkey")).alias("cuhid"), ip_text("o_orderkey").alias("ip_addr"),
                           F.col("o_orderdate").alias("dtm_last_modified"))


def prepared(t: Tables) -> DataFrame:
    return matching.prepare_input(onboarding(t), "address", "city", "state", "zip")


def routed(t: Tables) -> DataFrame:
    return matching.route_rejects(matching.standardize_columns(prepared(t)))


def matched(t: Tables, rows: DataFrame | None = None) -> DataFrame:
    valid = (routed(t) if rows is None else rows).filter(F.col("reason").isNull())
    return matching.match_addresses(valid, address_master(t), lambda c: decrypt_id(c, FIXTURE_KEY))


def chain(t: Tables, uhids: DataFrame) -> DataFrame:
    return matching.identity_chain(uhids, partner_map(t), partner_activity(t), customer_id_map(t), ip_history(t))


def _ctx(df: DataFrame) -> DataFrame:
    return df.select("segment_name", "advertiser_name", "file_name", "uhid")


def identity(t: Tables) -> DataFrame:
    uh = _ctx(matched(t)).filter(F.col("uhid") != "-1").distinct()
    return chain(t, uh).select("segment_name", "advertiser_name", "file_name", "uhid", "nu_uhid", "cuhid", "ip_addr")


def gold(t: Tables, scope: Scope, known: DataFrame | None = None) -> DataFrame:
    """The gold table rows, by name (Q31): segment id, ids, hashed ip, load
    time. Pairs of ``known`` (segment_name, advertiser_name, segment_id) keep
    their id. The identity chain runs once: keys and rows both read what it has
    written into the scope's folder."""
    spark = t.spark
    ident = scope.written(identity(t))
    if known is None:
        known = spark.createDataFrame([], "segment_name string, advertiser_name string, segment_id bigint")
    keys = matching.assign_surrogate_keys(ident, known, ["segment_name", "advertiser_name"])
    g = ident.join(keys.drop("is_new"), ["segment_name", "advertiser_name"])
    hashed = F.when(F.col("ip_addr") == "0", F.lit("0")).otherwise(hash_ip("ip_addr", IP_SALT))
    return g.select("segment_id", "uhid", "nu_uhid", hashed.alias("hash_ip_addr"), "file_name",
                    F.current_timestamp().alias("dtm_created"), "segment_name", "advertiser_name")


GOLD_DDL = ("segment_id bigint, uhid string, nu_uhid string, hash_ip_addr string, file_name string, "
            "dtm_created timestamp, segment_name string, advertiser_name string")


def publish_gold(spark, t: Tables, table: str | None = None) -> str:
    """PIP-11 / SNK-03: the gold table partitioned by (segment, advertiser);
    every file's partition is replaced in one dynamic INSERT OVERWRITE, so
    a rerun publishes the same rows again. Pairs that ``table`` already holds
    keep their segment id; without ``table`` a new one is made. Returns its
    name."""
    known = None
    with Scope(spark) as scope:
        if table is None:
            table = f"gold_{uuid.uuid4().hex[:10]}"
            writers.create_partitioned_table(spark, table, GOLD_DDL, ["segment_name", "advertiser_name"],
                                             scratch_path(spark, "gold"))
        else:
            # the ids are read before their partitions are replaced
            known = scope.written(spark.table(table).select("segment_name", "advertiser_name", "segment_id").distinct())
        writers.insert_overwrite(gold(t, scope, known), table)
    return table


# ---------------------------------------------------------------- oracle SQL

def _std_line1_sql(x: str) -> str:
    e = f"upper(regexp_replace(trim({x}), '\\s+', ' ', 'g'))"
    for short, long in matching.STREET_SUFFIXES:
        e = f"regexp_replace({e}, ' {short}$', ' {long}')"
    return e


FIXTURE_SQL = f"""
onb AS (
  SELECT lower(c.c_mktsegment) AS segment_name, lower(r.r_name) AS advertiser_name,
         lower(c.c_mktsegment) || '_' || lower(r.r_name) || '_{FILE_DAY:%Y%m%d}.csv' AS file_name,
         CASE WHEN c.c_acctbal < 0 THEN '   ' ELSE ' ' || CAST(c.c_custkey AS VARCHAR) || '  ' || lower(n.n_name) || ' St ' END AS address,
         ' ' || n.n_name AS city, r.r_name AS state,
         CASE WHEN c.c_acctbal >= 0 AND c.c_acctbal < 200 THEN 'n/a'
              ELSE CAST(c.c_nationkey * 37 + 10000 AS VARCHAR) END AS zip
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
inp AS (
  SELECT segment_name, advertiser_name, file_name, lower(trim(address)) AS input_street, '' AS input_secondary,
         COALESCE(lower(trim(zip)), '') AS input_zip, COALESCE(lower(trim(city)), '') AS input_city,
         COALESCE(lower(trim(state)), '') AS input_state FROM onb),
std AS (
  SELECT *,
    CASE WHEN trim(input_street) <> '' THEN nullif({_std_line1_sql('input_street')}, '') END AS std_delivery_line_1,
    CASE WHEN trim(input_street) <> '' THEN nullif(upper(trim(input_secondary)), '') END AS std_delivery_line_2,
    CASE WHEN trim(input_street) <> '' AND regexp_matches(trim(input_zip), '^[0-9]{{5}}$') THEN trim(input_zip) END AS std_zipcode,
    CASE WHEN trim(input_street) <> '' THEN nullif(upper(trim(input_city)), '') END AS std_city,
    CASE WHEN trim(input_street) <> '' THEN nullif(upper(trim(input_state)), '') END AS std_state
  FROM inp),
routed AS (
  SELECT *, CASE
      WHEN std_delivery_line_1 IS NULL AND std_zipcode IS NULL AND std_city IS NULL AND std_state IS NULL
        THEN 'NON_STANDARDIZED_ADDRESS'
      WHEN std_delivery_line_1 IS NULL OR std_zipcode IS NULL OR std_city IS NULL OR std_state IS NULL
        THEN 'PARTIAL' END AS reason
  FROM std),
master AS (
  SELECT CAST(c.c_custkey AS VARCHAR) || ' ' || n.n_name || ' STREET' AS standard_delivery_line_1,
         CAST(NULL AS VARCHAR) AS standard_delivery_line_2, CAST(c.c_nationkey * 37 + 10000 AS VARCHAR) AS standard_zipcode,
         ' ' || n.n_name || ' ' AS standard_city, r.r_name AS standard_state, 'u' || CAST(c.c_custkey AS VARCHAR) AS plain_uhid
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE c.c_mktsegment <> 'AUTOMOBILE'),
wanted AS (
  SELECT *, list_transform([std_delivery_line_1, std_delivery_line_2, std_zipcode, std_city, std_state],
                           lambda f: nullif(trim(f), '')) AS place
  FROM routed WHERE reason IS NULL),
known AS (
  SELECT plain_uhid, list_transform([standard_delivery_line_1, standard_delivery_line_2, standard_zipcode, standard_city, standard_state],
                                    lambda f: nullif(trim(f), '')) AS place
  FROM master),
matched AS (
  SELECT wanted.* EXCLUDE (place), COALESCE(known.plain_uhid, '-1') AS uhid
  FROM wanted LEFT JOIN known ON wanted.place IS NOT DISTINCT FROM known.place),
numap AS (SELECT 'n' || CAST(c_custkey AS VARCHAR) AS nu_uhid, 'u' || CAST(c_custkey AS VARCHAR) AS uhid
          FROM customer WHERE c_acctbal > 1000),
inward AS (SELECT 'n' || CAST(o_custkey AS VARCHAR) AS custid, CASE WHEN o_orderstatus = 'O' THEN 'Y' ELSE 'N' END AS dsp_flag
           FROM orders),
apmap AS (SELECT 'c' || CAST(c_custkey AS VARCHAR) AS cuhid, 'u' || CAST(c_custkey AS VARCHAR) AS uhid
          FROM customer WHERE c_nationkey < 20),
isp AS (SELECT 'c' || CAST(o_custkey AS VARCHAR) AS cuhid,
               '10.' || CAST(o_orderkey // 65536 % 256 AS VARCHAR) || '.' || CAST(o_orderkey // 256 % 256 AS VARCHAR)
               || '.' || CAST(o_orderkey % 256 AS VARCHAR) AS ip_addr, o_orderdate AS dtm_last_modified FROM orders)
"""


def chain_sql(ids_cte: str) -> str:
    return f"""
ca AS (SELECT i.segment_name, i.advertiser_name, i.file_name, i.uhid, COALESCE(m.nu_uhid, '0') AS nu0
       FROM {ids_cte} i LEFT JOIN numap m ON i.uhid = m.uhid),
act AS (SELECT DISTINCT custid FROM inward WHERE dsp_flag = 'Y'),
cb AS (SELECT ca.segment_name, ca.advertiser_name, ca.file_name, ca.uhid, COALESCE(act.custid, '0') AS nu_uhid
       FROM ca LEFT JOIN act ON ca.nu0 = act.custid),
cc AS (SELECT cb.*, COALESCE(ap.cuhid, '0') AS cuhid FROM cb LEFT JOIN apmap ap ON cb.uhid = ap.uhid),
lat AS (SELECT cuhid, ip_addr FROM (
          SELECT cuhid, ip_addr, row_number() OVER (PARTITION BY cuhid ORDER BY dtm_last_modified DESC, ip_addr DESC) AS rn
          FROM isp) WHERE rn = 1),
ident AS (SELECT cc.segment_name, cc.advertiser_name, cc.file_name, cc.uhid, cc.nu_uhid, cc.cuhid,
                 COALESCE(lat.ip_addr, '0') AS ip_addr FROM cc LEFT JOIN lat ON cc.cuhid = lat.cuhid)
"""


IDENT_SQL = "WITH " + FIXTURE_SQL + ",\nids AS (SELECT DISTINCT segment_name, advertiser_name, file_name, uhid " \
    "FROM matched WHERE uhid <> '-1'),\n" + chain_sql("ids")

GOLD_SQL = IDENT_SQL + f""",
keys AS (SELECT segment_name, advertiser_name,
                CAST(row_number() OVER (ORDER BY segment_name, advertiser_name) AS BIGINT) AS segment_id
         FROM (SELECT DISTINCT segment_name, advertiser_name FROM ident)),
gold AS (SELECT k.segment_id, i.uhid, i.nu_uhid,
                CASE WHEN i.ip_addr = '0' THEN '0' ELSE sha256('{IP_SALT}' || i.ip_addr) END AS hash_ip_addr,
                i.file_name, i.segment_name, i.advertiser_name
         FROM ident i JOIN keys k ON i.segment_name = k.segment_name AND i.advertiser_name = k.advertiser_name)
"""

_SRC = "segment_name, advertiser_name, file_name"


STANDARDIZED_SQL = "WITH " + FIXTURE_SQL + f"""
SELECT {_SRC}, input_street, input_secondary, input_zip, input_city, input_state,
       std_delivery_line_1, std_delivery_line_2, std_zipcode, std_city, std_state, CAST(NULL AS VARCHAR) AS std_error
FROM std"""


@query("match_standardize_batches", STANDARDIZED_SQL)
def match_standardize_batches(spark, sf):
    """UDF-04: the batch standardiser path (mapInPandas, 100 rows per call)."""
    return matching.standardize_batches(prepared(Tables(spark, sf)))


@query("match_standardize_lookup", STANDARDIZED_SQL)
def match_standardize_lookup(spark, sf):
    """UDF-04 as a lookup that fills itself: the files of one segment first, then
    all of them; the second run sends only what the first has not stored."""
    src, store = prepared(Tables(spark, sf)), scratch_path(spark, "addresses")
    matching.standardize_lookup(src.where("segment_name = 'building'"), store)
    return matching.standardize_lookup(src, store)


@query("match_address_left", "WITH " + FIXTURE_SQL + f"""
SELECT {_SRC}, input_street AS src_street, input_zip AS src_zipcode, input_city AS src_city,
       input_state AS src_state, uhid FROM matched""")
def match_address_left(spark, sf):
    """JON-05 / STR-02 / HSH-02 / UDF-04: rows standardised through the stored
    replies, left-joined to the address master on five normalised fields;
    decrypted id or '-1'."""
    t = Tables(spark, sf)
    m = matched(t, matching.route_rejects(matching.standardize_lookup(prepared(t), scratch_path(spark, "addresses"))))
    return m.select("segment_name", "advertiser_name", "file_name", F.col("input_street").alias("src_street"),
                    F.col("input_zip").alias("src_zipcode"), F.col("input_city").alias("src_city"),
                    F.col("input_state").alias("src_state"), "uhid")


@query("match_decrypt_roundtrip", """
SELECT c_custkey, 'u' || CAST(c_custkey AS VARCHAR) AS plain_id, 'u' || CAST(c_custkey AS VARCHAR) AS decrypted_id
FROM customer""")
def match_decrypt_roundtrip(spark, sf):
    """HSH-02: encrypt then decrypt every customer id; equals the plain id."""
    c = Tables(spark, sf).customer.select("c_custkey", F.concat(F.lit("u"), _s("c_custkey")).alias("plain_id"))
    enc = c.withColumn("_enc", encrypt_id("plain_id", FIXTURE_KEY))
    return enc.select("c_custkey", "plain_id", decrypt_id("_enc", FIXTURE_KEY).alias("decrypted_id"))


@query("match_identity", IDENT_SQL + "SELECT * FROM ident")
def match_identity(spark, sf):
    """PIP-07: address path of the identity chain, all files at once."""
    return identity(Tables(spark, sf))


ID_FILES_SQL = """
idin AS (SELECT DISTINCT 'idlist' AS segment_name, lower(o_orderstatus) AS advertiser_name,
                'idlist_' || lower(o_orderstatus) || '_20240101.csv' AS file_name,
                lower(trim(' U' || CAST(o_custkey AS VARCHAR) || ' ')) AS uhid FROM orders),
"""


def id_files(t: Tables) -> DataFrame:
    """Incoming rows of files that hold ids only, in the layout of all incoming rows."""
    o = t.orders
    none = F.lit("")
    return o.select(F.lit("idlist").alias("segment_name"), F.lower("o_orderstatus").alias("advertiser_name"),
                    F.concat(F.lit("idlist_"), F.lower("o_orderstatus"), F.lit("_20240101.csv")).alias("file_name"),
                    F.concat(F.lit(" U"), _s("o_custkey"), F.lit(" ")).alias("address"), none.alias("city"), none.alias("state"), none.alias("zip"))


def identity_of(t: Tables, incoming: DataFrame) -> DataFrame:
    """PIP-09: files of either layout through one chain; any other layout is an error."""
    addresses, only_ids = matching.by_layout(incoming)
    std = matching.standardize_columns(matching.prepare_input(addresses, "address", "city", "state", "zip"))
    found = _ctx(matched(t, matching.route_rejects(std))).filter(F.col("uhid") != "-1")
    given = _ctx(only_ids.withColumn("uhid", lower_trim("address")))
    return chain(t, found.unionByName(given).distinct()).select("segment_name", "advertiser_name", "file_name", "uhid", "nu_uhid", "cuhid", "ip_addr")


@query("match_identity_ids_only", "WITH " + FIXTURE_SQL + "," + ID_FILES_SQL + chain_sql("idin") + "SELECT * FROM ident")
def match_identity_ids_only(spark, sf):
    """PIP-09: files with only an id column skip standardisation:
    ``lower(trim(id))``, distinct, then the same chain."""
    t = Tables(spark, sf)
    return identity_of(t, id_files(t))


@query("match_identity_mixed", "WITH " + FIXTURE_SQL + "," + ID_FILES_SQL + """ids AS (
SELECT DISTINCT segment_name, advertiser_name, file_name, uhid FROM matched WHERE uhid <> '-1' UNION SELECT * FROM idin),
""" + chain_sql("ids") + "SELECT * FROM ident")
def match_identity_mixed(spark, sf):
    """PIP-09 / PIP-07: address files and id files arrive together and take
    their own ways into the chain."""
    t = Tables(spark, sf)
    return identity_of(t, onboarding(t).unionByName(id_files(t)))


@query("dq_reject_routing", "WITH " + FIXTURE_SQL + f"""
SELECT input_street AS src_street, input_zip AS src_zipcode, input_city AS src_city, input_state AS src_state,
       reason, {_SRC} FROM routed WHERE reason IS NOT NULL
UNION ALL
SELECT input_street, input_zip, input_city, input_state, 'NON_MATCHED_ADDRESS', {_SRC}
FROM matched WHERE uhid = '-1'""")
def dq_reject_routing(spark, sf):
    """PIP-08 / SNK-05 / DAT-05: rejects appended (INSERT INTO, by name) to a
    rejects table partitioned by segment and advertiser, each with its
    reason and the load time; read back without the load time. Valid and
    rejected rows add up to the input."""
    t = Tables(spark, sf)
    cols = [F.col("input_street").alias("src_street"), F.col("input_zip").alias("src_zipcode"),
            F.col("input_city").alias("src_city"), F.col("input_state").alias("src_state"), "reason",
            "segment_name", "advertiser_name", "file_name"]
    table = f"rejects_{uuid.uuid4().hex[:10]}"
    writers.create_partitioned_table(
        spark, table, "src_street string, src_zipcode string, src_city string, src_state string, reason string, "
        "file_name string, dtm_created timestamp, segment_name string, advertiser_name string",
        ["segment_name", "advertiser_name"], scratch_path(spark, "rejects"))
    with Scope(spark) as scope:
        # standardised once: what is split below is what the scope's folder holds
        all_rows = scope.written(routed(t))
        bad = all_rows.filter(F.col("reason").isNotNull()).select(*cols)
        unmatched = (matched(t, all_rows).filter(F.col("uhid") == "-1")
                     .withColumn("reason", F.lit(matching.REASON_NON_MATCHED)).select(*cols))
        writers.append_into(bad.unionByName(unmatched).withColumn("dtm_created", F.current_timestamp()), table)
    return spark.table(table).drop("dtm_created")


@query("surrogate_key_assign", """
WITH existing AS (
  SELECT p_brand, p_type, CAST(row_number() OVER (ORDER BY p_brand, p_type) AS BIGINT) AS segment_id
  FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size <= 25)),
incoming AS (SELECT DISTINCT p_brand, p_type FROM part),
fresh AS (SELECT i.p_brand, i.p_type FROM incoming i
          WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.p_brand = i.p_brand AND e.p_type = i.p_type))
SELECT i.p_brand, i.p_type, e.segment_id, false AS is_new
FROM incoming i JOIN existing e ON i.p_brand = e.p_brand AND i.p_type = e.p_type
UNION ALL
SELECT p_brand, p_type, (SELECT max(segment_id) FROM existing) + row_number() OVER (ORDER BY p_brand, p_type), true
FROM fresh""")
def surrogate_key_assign(spark, sf):
    """PIP-10: (brand, type) pairs of small parts already have ids; all
    pairs arrive; known pairs keep their id, new ones get max + 1, ..."""
    p = Tables(spark, sf).part
    empty = spark.createDataFrame([], "p_brand string, p_type string, segment_id bigint")
    existing = matching.assign_surrogate_keys(p.filter(F.col("p_size") <= 25), empty, ["p_brand", "p_type"])
    return matching.assign_surrogate_keys(p, existing.drop("is_new"), ["p_brand", "p_type"])


# ------------------------------------------------------------------ extracts

def _segment_ips(t: Tables) -> DataFrame:
    """The ip feed: every order's ip, delivered in monthly files (source_date
    = first day of the order's month)."""
    return ip_history(t).select(F.col("ip_addr").alias("ip"),
                                F.trunc(F.to_date("dtm_last_modified"), "month").alias("source_date"))


@query("extract_hash_map", f"""
SELECT DISTINCT sha256('{IP_SALT}' || '10.' || CAST(o_orderkey // 65536 % 256 AS VARCHAR) || '.'
                       || CAST(o_orderkey // 256 % 256 AS VARCHAR) || '.' || CAST(o_orderkey % 256 AS VARCHAR)) AS hash_ip_addr,
       '10.' || CAST(o_orderkey // 65536 % 256 AS VARCHAR) || '.' || CAST(o_orderkey // 256 % 256 AS VARCHAR)
       || '.' || CAST(o_orderkey % 256 AS VARCHAR) AS ip,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS source_date
FROM orders""")
def extract_hash_map(spark, sf):
    """PIP-12: build the missing date partitions of the hash map; a second
    run finds them all present and writes nothing."""
    t = Tables(spark, sf)
    path = scratch_path(spark, "hash-map")
    extracts.upkeep_hash_map(spark, _segment_ips(t), path, IP_SALT)
    return extracts.upkeep_hash_map(spark, _segment_ips(t), path, IP_SALT)


NU_SQL = "SELECT file_name, nu_uhid FROM gold WHERE length(nu_uhid) > 2"
UH_SQL = "SELECT file_name, uhid FROM gold WHERE length(uhid) > 2 AND (length(nu_uhid) > 2 OR length(hash_ip_addr) > 2)"
IP_SQL = f"""SELECT g.file_name, m.ip AS unhash_ip_addr
FROM gold g JOIN (SELECT DISTINCT sha256('{IP_SALT}' || ip_addr) AS hash_ip_addr, ip_addr AS ip FROM isp) m ON g.hash_ip_addr = m.hash_ip_addr
WHERE length(g.hash_ip_addr) > 2"""


def _one_extract(spark, sf, kind: str) -> DataFrame:
    t = Tables(spark, sf)
    base = scratch_path(spark, "extracts")
    with Scope(spark) as scope:
        g = scope.persist(spark.table(publish_gold(spark, t)))
        hm = extracts.upkeep_hash_map(spark, _segment_ips(t), scratch_path(spark, "hash-map"), IP_SALT) if kind == "ip" else None
        path = extracts.write_extract(extracts.EXTRACTS[kind](g, hm), base, kind)
    return extracts.read_extract(spark, path, extracts.COLUMNS[kind])


@query("extract_partner_ids", GOLD_SQL + NU_SQL)
def extract_partner_ids(spark, sf):
    return _one_extract(spark, sf, "nu")


@query("extract_ids", GOLD_SQL + UH_SQL)
def extract_ids(spark, sf):
    return _one_extract(spark, sf, "uh")


@query("extract_unhash_ip", GOLD_SQL + IP_SQL)
def extract_unhash_ip(spark, sf):
    return _one_extract(spark, sf, "ip")


@query("extract_all", GOLD_SQL + f"""
SELECT file_name AS extract, nu_uhid AS value FROM ({NU_SQL})
UNION ALL SELECT 'uh_' || file_name, uhid FROM ({UH_SQL})
UNION ALL SELECT 'ip_' || file_name, unhash_ip_addr FROM ({IP_SQL})""")
def extract_all(spark, sf):
    """PIP-13 / SNK-10 / STR-08 / PRT-05: the three extracts of one gold publish,
    read once into a persisted frame, under the caller's file names: ``<file>``,
    ``uh_<file>`` and ``ip_<file>``; what was kept for them is given back."""
    t = Tables(spark, sf)
    base = scratch_path(spark, "extracts")
    with Scope(spark) as scope:
        gold_rows = scope.persist(spark.table(publish_gold(spark, t)).select("file_name", "uhid", "nu_uhid", "hash_ip_addr"))
        hm = extracts.upkeep_hash_map(spark, _segment_ips(t), f"{scope.folder}/hash-map", IP_SALT)
        path = extracts.publish_extracts(gold_rows, hm, base)
    return extracts.read_extract(spark, path, "value").select(F.col("file_name").alias("extract"), "value")
