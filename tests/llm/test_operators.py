"""Each operator against brute force on small tables, with the odd cases its docstring defines."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
WORDS = r"[^\x20\x09-\x0D]+"


def docs_of(spark, name="documents"):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def fold(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# ---------------------------------------------------------------- 1

def test_urls(spark):
    from kestrel.llm.queries import URL_RULES
    from kestrel.llm.urls import judge

    bad, good = [(i, f"http://bad.shop.info/p/{i}?ref=1") for i in range(30)], [(100 + i, f"http://ok.shop.info/p/{i}?x=1") for i in range(60)]
    given = [(901, "http://Foo.NET/"), (902, "HTTP://a.example.NET/en/x"), (903, "http://www.example.com/de/1"), (904, "x://example.org/fr/?q"),
             (905, "http://notexample.com/de/"), (906, None), (907, "no scheme"), (908, "http://foo.net"), (909, "s://h#f://y/z"), (909, "s://h#f://y/z"), (None, "http://bad.a.info/p/1?ref=2")]
    pages = spark.createDataFrame([(*r, "x") for r in bad + good + given], "page_id long, url string, tokens string")
    labels = spark.createDataFrame([(i, True) for i in range(25)] + [(100 + i, False) for i in range(50)] + [(None, True), (0, None)], "page_id long, block boolean")
    rows = judge(pages, labels, URL_RULES).collect()
    assert len(rows) == len(bad + good + given)
    got = {r["page_id"]: r for r in rows}
    assert all(got[i]["verdict"] == "block" and got[i]["mined"] for i, _ in bad) and all(got[i]["verdict"] == "allow" for i, _ in good)
    want = {901: ("foo.net", "/", "net/", "block"), 902: ("a.example.net", "/en/x", "example.net/en/", "allow"), 903: ("www.example.com", "/de/1", "example.com/de/", "block"),
            904: ("example.org", "/fr/", "org/fr/", "allow"), 905: ("notexample.com", "/de/", None, "allow"), 906: ("", "", None, "allow"),
            907: ("", "", None, "allow"), 908: ("foo.net", "", None, "allow"), 909: ("h", "", None, "allow"), None: ("bad.a.info", "/p/1", None, "block")}
    assert {k: tuple(got[k][c] for c in ("host", "path", "rule", "verdict")) for k in want} == want
    assert judge(pages.limit(0), labels, URL_RULES).count() == 0
    assert {r["verdict"] for r in judge(pages.where("page_id < 200"), labels.limit(0), []).collect()} == {"allow"}


def test_mined_rules_are_the_minimal_confident_sets(spark):
    from kestrel.llm.urls import mine, tokens

    rng = random.Random(3)
    urls = [(i, f"http://{rng.choice('ab')}.{rng.choice('xy')}.t/{rng.choice('mn')}?{rng.choice('qr')}=1") for i in range(120)]
    block = {i: ("//a.x" in u) or ("y.t/n?r" in u and rng.random() < 0.9) for i, u in urls}
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame(list(block.items()), "page_id long, block boolean")
    got = {tuple(r["antecedent"]) for r in mine(pages, labels, 0.02, 0.8, 1.2, 1).collect()}
    sets = {r[0]: frozenset(r[1]) for r in pages.select("page_id", tokens(F.col("url"))).collect()}
    every, base, good = set().union(*sets.values()), sum(block.values()) / 120, []
    for n in range(1, len(every) + 1):
        for c in combinations(sorted(every), n):
            has = [i for i, s in sets.items() if s.issuperset(c)]
            hit = sum(block[i] for i in has)
            if hit >= 0.02 * 120 and hit / len(has) >= 0.8 and hit / len(has) / base >= 1.2 and not any(set(g) < set(c) for g in good):
                good.append(c)
    assert got == set(good) and got


# ---------------------------------------------------------------- 2

def substrings(rows, k=13):
    first = {}
    words = [(i, re.findall(WORDS, t or "")) for i, t in rows]
    for i, w in words:
        for a in range(len(w) - k + 1) if i is not None else ():
            s = tuple(w[a:a + k])
            first[s] = min(first.get(s, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for a in range(len(w) - k + 1) if i is not None else ():
            if first[tuple(w[a:a + k])] < i:
                gone[a:a + k] = [True] * k
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("block_bytes", [2_000, 1 << 20])
def test_substrings(spark, odd, block_bytes):
    from kestrel.llm.substrings import dedup_substrings

    rng = random.Random(5)
    text = [[rng.choice("abc") + str(rng.randint(0, 30)) for _ in range(60)] for _ in range(12)]
    rows = [(i, " ".join(sum((rng.choice(text)[rng.randint(0, 20):][: rng.randint(5, 50)] for _ in range(4)), []))) for i in range(120)]
    rows += [(200, "a " * 300), (201, "a " * 40), (202, rows[3][1]), (202, rows[3][1])]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, dedup_substrings(made, block_bytes=block_bytes).collect())) == sorted(substrings(rows))
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert sorted(map(str, map(tuple, dedup_substrings(odd, block_bytes=block_bytes).collect()))) == sorted(map(str, substrings(rows)))


def test_substrings_empty_and_spans(spark, none):
    from kestrel.llm.substrings import dedup_substrings, spans

    assert dedup_substrings(none).count() == 0
    text = " ".join(f"w{i}" for i in range(50))
    made = spark.createDataFrame([(1, "x " + text), (2, text + " y"), (3, "z " + text)], "doc_id long, text string")
    assert [(r["src_doc"], r["src_at"], r["n"]) for r in spans(made).collect()] == [(1, 1, 50)]


# ---------------------------------------------------------------- 3

def contamination(rows, items, n=10):
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    wins = defaultdict(set)
    for i, t in items:
        w = re.findall(word, fold(t))
        m = min(n, len(w))
        for a in range(len(w) - m + 1) if m else ():
            wins[tuple(w[a:a + m])].add(i)
    out = []
    for i, t in rows:
        w = re.findall(word, fold(t))
        hit, found = [False] * len(w), set()
        for m in {len(x) for x in wins}:
            for a in range(len(w) - m + 1):
                if tuple(w[a:a + m]) in wins:
                    hit[a:a + m] = [True] * m
                    found |= wins[tuple(w[a:a + m])]
        out.append((i, len(w), sum(hit), sorted(str(x) for x in found if x is not None)))
    return out


@pytest.mark.parametrize("index_bytes", [0, 1 << 20])
def test_contamination(spark, odd, none, index_bytes):
    from kestrel.llm.decontaminate import drop_contaminated, find_contamination

    items = [tuple(r) for r in docs_of(spark, "benchmark").select("item_id", "text").collect()]
    items += [(900, "the CAT, sat"), (901, "w1 and w2 and"), (None, "x"), (902, None), (903, "... "), (902, "a hat and a bat"), (904, "a hat and a bat")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for docs in (docs_of(spark), odd):
        got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in find_contamination(docs, bench, index_bytes=index_bytes).collect()]
        want = contamination([tuple(r) for r in docs.select("doc_id", "text").collect()], items)
        assert sorted(map(str, got)) == sorted(map(str, want))
        assert any(w[2] for w in want)
    span = {r["doc_id"]: r["spans"] for r in find_contamination(odd, bench, index_bytes=index_bytes).collect()}
    assert [tuple(s) for s in span[1]] == [(0, 3), (7, 5)]
    kept = drop_contaminated(odd, bench, index_bytes=index_bytes)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {2, 3, 4, None, 8, 9}
    assert find_contamination(none, bench, index_bytes=index_bytes).count() == 0
    assert find_contamination(odd, bench.limit(0), index_bytes=index_bytes).agg(F.sum("n_hit")).first()[0] == 0


# ---------------------------------------------------------------- 4

def line_dedup(rows, depth=2, min_words=8, min_docs=3):
    docs, lines = defaultdict(set), []
    for r, (i, t) in enumerate(rows):
        for line in t.split("\n") if t is not None else ():
            w = ["<*>" if re.search("[0-9]", x) else x for x in re.findall(WORDS, line)]
            keys = []
            if len(w) >= max(min_words, depth + 4):
                rest = len(w) - depth
                c = [depth + rest * q // 4 for q in range(5)]
                keys = [(len(w), q, tuple(w[:c[q]]), tuple(w[c[q + 1]:])) for q in range(4)]
                for k in keys:
                    docs[k].add(r)
            lines.append((r, i, line, keys))
    keep, n, total = defaultdict(list), defaultdict(int), defaultdict(int)
    for r, i, line, keys in lines:
        total[r] += 1
        least = [min((rows[x][0] for x in docs[k] if rows[x][0] is not None), default=None) for k in keys]
        if any(len(docs[k]) >= min_docs and (i is None or m < i) for k, m in zip(keys, least, strict=True)):
            n[r] += 1
        else:
            keep[r].append(line)
    return [(i, total[r], n[r], None if t is None else "\n".join(keep[r])) for r, (i, t) in enumerate(rows)]


def test_lines(spark, odd, none):
    from kestrel.llm.lines import dedup_lines

    line = "served by node {} at port {} with status ok and nothing more {}"
    rows = [(i, f"own text {i}\n" + line.format(i, i * 7, "x")) for i in range(6)] + [(10, "a b c d e f g h\n\n"), (11, "a b c d e f g h"), (None, "a b c X e f g h"), (None, line.format(1, 2, "y"))]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    for docs in (made, docs_of(spark), odd):
        for size in (3_000, 1 << 20):
            out = dedup_lines(docs, block_bytes=size)
            assert out.columns == [*docs.columns, "_n_lines", "_n_dropped"]
            got = [tuple(r) for r in out.select("doc_id", "_n_lines", "_n_dropped", "text").collect()]
            assert sorted(map(str, got)) == sorted(map(str, line_dedup([tuple(r) for r in docs.select("doc_id", "text").collect()])))
    assert dedup_lines(made).agg(F.sum("_n_dropped")).first()[0] >= 6
    assert {r["_b"] for r in dedup_lines(odd).select("_b").collect()} == {7}
    with pytest.raises(ValueError):
        dedup_lines(odd.withColumn("_n_lines", F.lit(1)))
    assert dedup_lines(odd.withColumn("_n_lines", F.lit(1)), counts=("lines", "gone")).columns == [*odd.columns, "_n_lines", "lines", "gone"]
    assert dedup_lines(none).count() == 0


def whole_line_dedup(rows, whole_docs):
    """As ``line_dedup``, and every line with words goes if all of them (digits aside) stand in ``whole_docs`` documents."""
    def fields(line):
        return tuple("<*>" if re.search("[0-9]", x) else x for x in re.findall(WORDS, line))

    docs, out = defaultdict(set), []
    for r, (_, t) in enumerate(rows):
        for line in t.split("\n") if t is not None else ():
            docs[fields(line)].add(r)
    for r, ((i, t), (_, total, _, kept)) in enumerate(zip(rows, line_dedup(rows), strict=True)):
        left = []
        for line in kept.split("\n") if kept else ():
            least = min((rows[x][0] for x in docs[fields(line)] if rows[x][0] is not None), default=None)
            if not (fields(line) and len(docs[fields(line)]) >= whole_docs and (i is None or least < i)):
                left.append(line)
        out.append((i, total, None if t is None else "\n".join(left)))
    return out


def test_short_lines_and_lines_of_two_documents(spark, odd, none):
    from kestrel.llm.lines import dedup_lines
    from kestrel.llm.queries import op4_line_dedup

    short, long = "All rights reserved.", "a passage of well over eight words that two otherwise different documents share"
    rows = [(1, f"one\n{short}\nversion 1"), (2, f"two\n{short}\nversion 2"), (3, f"three\n{long}"), (4, f"four\n\n{long}\n{short}"), (None, "five\nversion 3"), (6, None), (7, "")]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in dedup_lines(made, whole_docs=2).collect()}
    assert got == {1: rows[0][1], 2: "two", 3: rows[2][1], 4: "four\n", None: "five", 6: None, 7: ""}
    for docs in (made, docs_of(spark), odd):
        for size, whole in ((3_000, 2), (1 << 20, 3)):
            got = [(r["doc_id"], r["_n_lines"], r["text"]) for r in dedup_lines(docs, block_bytes=size, whole_docs=whole).collect()]
            assert sorted(map(str, got)) == sorted(map(str, whole_line_dedup([tuple(r) for r in docs.select("doc_id", "text").collect()], whole)))
    assert dedup_lines(none, whole_docs=2).count() == 0
    query = {r["doc_id"]: r["text"] for r in op4_line_dedup(spark, SMALL).collect()}
    assert query == {i: t for i, _, t in whole_line_dedup([tuple(r) for r in docs_of(spark).select("doc_id", "text").collect()], 2)}


# ---------------------------------------------------------------- 5

def test_language(spark, odd, none):
    from kestrel.llm.languages import fit, identify, keep_identified
    from kestrel.llm.queries import op5_language_id

    rows = op5_language_id(spark, SMALL).join(docs_of(spark).select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs_of(spark).count() and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    model = fit(docs_of(spark), sample=30)
    got = identify(odd, model).collect()
    assert len(got) == odd.count()
    for r in got:
        if r["doc_id"] in (2, 3, 4, 8):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
    kept = keep_identified(odd, model)
    assert kept.columns == odd.columns and {2, 3, 4, 8}.isdisjoint(r["doc_id"] for r in kept.collect())
    foreign = spark.createDataFrame([(1, "Ж" * 40 + " ЩЫЪ ЖЖЮЮ " * 20)], "doc_id long, text string")
    assert identify(foreign, model).first()["rejected"]
    empty = fit(none)
    assert {r["lang_pred"] for r in identify(odd, empty).collect()} == {"und"} and identify(none, model).count() == 0


def test_language_limits_hold_with_empty_and_strange_texts_among_the_labelled(spark):
    from kestrel.llm.languages import fit, identify

    docs = docs_of(spark).select("doc_id", "text", "lang")
    strange = ["", None, "!!! 123", " \n\t ", "x"]
    rows = [(10_000 + 10 * i + j, t, lang) for i, lang in enumerate(("de", "en", "es", "fr")) for j, t in enumerate(strange)]
    model = fit(docs.union(spark.createDataFrame(rows, docs.schema)))
    assert {lang: model.languages.count(lang) for lang in model.languages} == {"de": 4, "en": 4, "es": 4, "fr": 4} and (model.least > 0.05).all()
    noise = [(1, "Россия — государство в Восточной Европе и Северной Азии."), (2, "中国是位于东亚的国家，首都为北京。"), (3, "روسيا دولة تقع في شرق أوروبا")]
    assert all(r["rejected"] for r in identify(spark.createDataFrame(noise, "doc_id long, text string"), model).collect())
    assert identify(docs, model).where("rejected").count() <= 2


def test_language_rejects_latin_script_of_no_learned_language_and_code(spark):
    from kestrel.llm.languages import fit, identify

    foreign = [
        "Suomi on tasavalta Pohjois-Euroopassa. Sen pääkaupunki on Helsinki ja siellä asuu yli puoli miljoonaa ihmistä. Maan suurimmat kaupungit ovat etelässä.",
        "Polska jest państwem położonym w Europie Środkowej. Stolicą kraju jest Warszawa, a największe miasta to także Kraków, Łódź, Wrocław i Poznań.",
        "Magyarország közép-európai ország, fővárosa Budapest. Lakosainak száma közel tízmillió, hivatalos nyelve a magyar.",
        "#include <stdio.h>\nint main(int argc, char **argv) {\n  for (int i = 0; i < argc; i++) {\n    printf(\"%s\\n\", argv[i]);\n  }\n  return 0;\n}\n",
    ]
    docs = docs_of(spark)
    model = fit(docs.where("doc_id % 4 > 0"))
    got = identify(spark.createDataFrame(list(enumerate(foreign)), "doc_id long, text string"), model).collect()
    assert [r["doc_id"] for r in got if not r["rejected"]] == []
    held = docs.where("doc_id % 4 = 0 and text rlike '[a-z]'")
    assert identify(held, model).where("rejected").count() <= 1


# ---------------------------------------------------------------- 6

def test_sketches(spark, odd, none):
    from kestrel.llm.sketches import Paragraphs, diff_versions, fingerprint_documents, sketch

    docs = docs_of(spark).select("doc_id", "text").union(spark.createDataFrame([(100_000, ""), (100_001, None), (100_002, "\n"), (None, "alone in the world")], "doc_id long, text string"))
    for size in (20_000, 1 << 22):
        got = {r["doc_id"]: r for r in fingerprint_documents(docs, size).collect()}
        rows = sorted((r["doc_id"], r["text"] or "") for r in docs.where("doc_id is not null").collect())
        assert len(got) == len(rows) + 1
        own = Paragraphs(pa.array([t for _, t in rows]))
        keys = [set() for _ in rows]
        for k, i in zip(own.key.tolist(), own.text.tolist(), strict=True):
            keys[i].add(k)
        names = sketch(own).strings()
        for n, (i, t) in enumerate(rows):
            follow = rows[(n + 1) % len(rows)][1]
            q = len(t) // 4
            edited = t[: len(t) - q] + follow[:q]
            a, b = keys[n], keys[(n + 1) % len(rows)]
            c = set(Paragraphs(pa.array([edited])).key.tolist())
            r = got[i]
            assert (r["n_chars"], r["edited_sha256"], r["fingerprint"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), names[n])
            assert r["near_next"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0) and r["near_edited"] == pytest.approx(len(a & c) / len(a | c) if a | c else 1.0)
        assert got[None]["n_chars"] == 18 and got[None]["near_next"] == 0
    assert fingerprint_documents(odd).count() == odd.count() and fingerprint_documents(none).count() == 0
    pairs = spark.createDataFrame([(1, "a\nb\nc", "a\nc\nd\nd"), (2, None, None), (3, "\n".join(map(str, range(900))), "")], "k long, x string, y string")
    got = {r["key"]: (len(r["only_left"]), len(r["only_right"])) for r in diff_versions(pairs, "x", "y", "k").collect()}
    assert got == {1: (1, 2), 2: (0, 0), 3: (900, 0)}


# ---------------------------------------------------------------- 7

def simhash(rows):
    from xxhash import xxh64_intdigest

    fps = []
    for _, t in rows:
        w = re.findall(WORDS, fold(t))
        h = [xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
        fps.append(sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)))
    return fps


def groups(rows, fps, radius=2):
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [(i, f"{fps[k]:016x}", least.get(find(k))) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("tile_rows", [3, 4096])
def test_simhash(spark, odd, none, tile_rows):
    from kestrel.llm.simhash import near_duplicates

    rows = [tuple(r) for r in docs_of(spark).union(odd.drop("_b", "fp", "n_hit")).select("doc_id", "text").collect()]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), tile_rows=tile_rows).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, groups(rows, simhash(rows))))
    assert near_duplicates(none, tile_rows=tile_rows).count() == 0 and near_duplicates(odd).count() == odd.count()


def test_links_over_tiles(spark):
    from kestrel.llm.components import components
    from kestrel.llm.simhash import links

    rng = random.Random(9)
    fps = {0}
    for _ in range(300):  # chains of one and two flipped bits
        x = rng.choice(sorted(fps)) if rng.random() < 0.9 else rng.getrandbits(64)
        fps.add(x ^ (1 << rng.randrange(64)) ^ (rng.random() < 0.6) * (1 << rng.randrange(64)))
    fps = sorted(fps)
    nodes = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    want = {f: c for f, (_, _, c) in zip(fps, groups([(i, "") for i in range(len(fps))], fps), strict=True)}
    for rows in (4, 4096):
        got = {int(np.int64(r["node"]).view(np.uint64)): r["root"] for r in components(links(nodes, tile_rows=rows)).collect()}
        linked = defaultdict(set)
        for f in fps:
            linked[got.get(f, f"alone {f}")].add(want[f])
        assert all(len(s) == 1 for s in linked.values()) and len(linked) == len(set(want.values()))


# ---------------------------------------------------------------- 8

def test_quality(spark, odd, none):
    from kestrel.llm.quality import FEATURES, features, fit, score, train

    rng = np.random.default_rng(0)
    x = rng.random((4000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # only a pair tells
    model = train(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() > 0.9
    f = features(pa.array(["One two two.\nOne", None, ""]))
    assert f.shape == (3, len(FEATURES)) and (f[1] == f[2]).all() and f[0][FEATURES.index("different_words")] == 0.75
    assert f[0][FEATURES.index("repeated_word")] == 0 and features(pa.array(["a a b"]))[0][FEATURES.index("repeated_word")] == pytest.approx(1 / 3)
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    made = fit(big, labels.where("doc_id % 3 > 0"))
    rows = score(big, made).join(labels, "doc_id").where("doc_id % 3 = 0").collect()
    assert sum((r["score"] >= 0.3) == (r["quality"] == 1) for r in rows) > 0.93 * len(rows)
    got = score(odd, made).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got) and score(none, made).count() == 0
    assert {round(r["score"], 6) for r in score(odd, fit(odd, labels.limit(0))).collect()} == {0.5}
    odd_labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (77, 1)], "doc_id long, quality int")
    assert score(odd, fit(odd, odd_labels)).count() == odd.count()


# ---------------------------------------------------------------- 9

def test_best_fit_finds_the_tightest_compatible_bin():
    from kestrel.llm.packing import best_fit

    rng = random.Random(2)
    items = sorted(((rng.randint(1, 60), 1 << rng.randint(0, 5), 1 << rng.randint(0, 40)) for _ in range(400)), reverse=True)
    bins, want = [], []
    for n, s, c in items:
        fit = [(b[0], k) for k, b in enumerate(bins) if b[0] >= n and not b[1] & s and not b[2] & c]
        k = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append([100, 0, 0])
        bins[k] = [bins[k][0] - n, bins[k][1] | s, bins[k][2] | c]
        want.append(k)
    assert best_fit(items, 100) == want


def test_packing(spark, odd, none):
    from kestrel.llm.packing import pack

    for docs in (docs_of(spark), odd):
        rows = pack(docs, 100, 64).collect()
        words = sorted((r["doc_id"] or -1, len(re.findall(WORDS, r["text"] or ""))) for r in docs.collect())
        total, want = defaultdict(int), defaultdict(int)
        for i, n in words:
            want[i] += n
        bins = defaultdict(list)
        for r in rows:
            total[r["doc_id"] or -1] += r["n_words"]
            assert (r["bin_id"] is None) == (r["n_words"] == 0) and r["first_word"] == r["piece"] * 100
            if r["n_words"]:
                bins[r["bin_id"]].append(r)
        assert total == want
        source = {r["doc_id"]: r["source"] for r in docs.collect()}
        for got in bins.values():
            assert sum(r["n_words"] for r in got) == got[0]["bin_words"] <= 100 and sorted(r["place"] for r in got) == list(range(len(got)))
            named = [source[r["doc_id"]] for r in got if source[r["doc_id"]] is not None]
            assert len(named) == len(set(named))
    assert pack(none).count() == 0


def test_no_bin_holds_two_of_a_cluster(spark):
    from kestrel.llm.packing import pack
    from kestrel.llm.simhash import near_duplicates

    words = [f"word{i}" for i in range(90)]
    near = [(20_000 + i, " ".join([*words[:80], f"end{i}"]), "en", f"source {i}", 1) for i in range(12)]
    docs = docs_of(spark).union(spark.createDataFrame(near, docs_of(spark).schema))
    cluster = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert len({cluster[i] for i, *_ in near}) < len(near)
    bins = defaultdict(list)
    rows = pack(docs, 400, 64).collect()
    for r in rows:
        bins[r["bin_id"]].append(cluster[r["doc_id"]])
    bins.pop(None, None)
    assert max(map(len, bins.values())) > 1 and all(len(b) == len(set(b)) for b in bins.values())
    # near copies without an id
    lone = spark.createDataFrame([(None, *r[1:]) for r in near], docs.schema)
    bins = [r["bin_id"] for r in pack(lone).collect()]
    assert len(bins) == len(near) and len(set(bins)) > 1
    assert sum(r["n_words"] for r in pack(docs, 400, 64, near=False).collect()) == sum(r["n_words"] for r in rows)


# ---------------------------------------------------------------- 10

def test_bit_packing_round_trip():
    from kestrel.llm.tokens import Block, pack, unpack, write_block

    for width in (1, 3, 8, 13, 16, 17, 31, 32):
        ids = np.random.default_rng(width).integers(0, 2**width, 777).astype(np.uint32)
        data = pack(ids, width)
        assert len(data) == -(-777 * width // 8) and (unpack(data, width, 0, 777) == ids).all() and (unpack(data, width, 301, 99) == ids[301:400]).all()
        b = Block(write_block([5, None, 7], np.array([700, 0, 77]), ids, width))
        assert b.doc_ids == [5, None, 7] and (b.document(2) == ids[700:]).all() and len(b.document(1)) == 0
    with pytest.raises(ValueError, match="token block"):
        Block(b"x" * 64)


def test_encoder_equals_the_library():
    import public_tokenizers

    from kestrel.llm.tokens import Encoder

    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "the", "é", "1", "'s", "'ll", "'", "_", "A2", ".", "!!", "\u00a0", "\u2003", "\x1c", "\x00", "中", "\u3000", "\ufeff", "😀", "<|endoftext|>", "\r\n", "\x85", "́", "²"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(9000)] + ["", None, " ", "x" * 5000]
    known = [b" the", b"a", b" a", b"'s", b" ", b"!!", b"abcdefghijklmnop", b"\n"]
    for name, frequent in (("byte_bpe_50k.json", ()), ("byte_bpe_50k.json", known), ("word_bpe_49k.json", known)):
        e = Encoder(public_tokenizers.path(name), frequent)
        e.KEEP = 300
        for i in range(0, len(texts), 600):
            some = texts[i: i + 600]
            ids, n = e.encode(pa.array(some, pa.string()))
            ends = np.cumsum(n)
            for t, a, b in zip(some, ends - n, ends, strict=True):
                assert ids[a:b].tolist() == [*e.tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        assert all(len(p) <= e.LONG for p in e.young) and len(e.size) < 20 * e.KEEP


def test_tokens(spark, odd, none, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    from kestrel.llm.tokens import read_tokens, write_tokens

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    for k, docs in enumerate((docs_of(spark), odd)):
        write_tokens(docs, path, f"{tmp_path}/{k}", block_tokens=500, block_bytes=20_000)
        rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
        ids = [np.array([*t.encode(x, add_special_tokens=False).ids, 0], "<u4") for _, x in rows]
        want, at = [], 0
        for (i, _), x in zip(rows, ids, strict=True):
            want.append((i, at, len(x), zlib.crc32(x.tobytes())))
            at += len(x)
        assert sorted(map(tuple, read_tokens(spark, f"{tmp_path}/{k}").collect()), key=lambda r: r[1]) == want
    write_tokens(none, path, f"{tmp_path}/none")
    assert read_tokens(spark, f"{tmp_path}/none").count() == 0


# ---------------------------------------------------------------- components, pipeline

def test_components(spark):
    from kestrel.llm.components import components

    edges = [(i, i + 1) for i in range(50)] + [(100, 200 + i) for i in range(40)] + [(7, 7), (None, 3), (300, 301), (301, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {**dict.fromkeys(range(51), 0), **dict.fromkeys([100, *range(200, 240)], 100), 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_pipeline(spark, odd, none, tmp_path):
    import corpus_pipeline as cp
    from kestrel.llm.decontaminate import find_contamination

    docs = docs_of(spark)
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SMALL)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        before, after = {r["doc_id"]: r for r in docs.collect()}, out.collect()
        if k < 4:
            assert out.columns == docs.columns
        if name == "line_dedup":
            want = {i: t for i, _, t in whole_line_dedup([(r["doc_id"], r["text"]) for r in before.values()], 2)}
            assert {r["doc_id"]: r["text"] for r in after} == want and all(r["n_chars"] == len(r["text"]) for r in after)
        if name == "simhash_near_dedup":
            rows = [(i, r["text"]) for i, r in before.items()]
            assert sorted(r["doc_id"] for r in after) == sorted({c for _, _, c in groups(rows, simhash(rows))})
        if name == "benchmark_decontamination":
            clean = find_contamination(docs, docs_of(spark, "benchmark")).where("n_hit = 0").collect()
            assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in clean)
        docs = out
    for _, stage in cp.STAGES:
        assert stage(spark, none, SMALL).count() == 0
        stage(spark, odd, SMALL).count()


def test_pipeline_drops_short_lines_and_lines_of_two_documents(spark):
    import corpus_pipeline as cp

    docs = spark.createDataFrame([(i, f"own words {chr(97 + i)} here\nAll rights reserved.\nbye {chr(97 + i // 2)}", "en", "s", 0) for i in range(10)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"].split("\n") for r in cp.line_dedup(spark, docs, SMALL).collect()}
    for i in range(10):
        assert got[i] == [f"own words {chr(97 + i)} here", *["All rights reserved."] * (i == 0), *[f"bye {chr(97 + i // 2)}"] * (i % 2 == 0)]


def test_contamination_goes_alike_by_either_way(spark):
    """Null and repeated ids, and texts without one: broadcast and join drop the same rows."""
    from kestrel.llm.decontaminate import drop_contaminated

    item = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(None, item, "a"), (None, "clean and without an id", "b"), (1, item + " more", "c"), (1, "clean under the same id", "d"), (2, None, "e"), (3, "", "f"), (1, item + " more", "g"), (4, "clean", "h")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, tag string, _row int")
    bench = spark.createDataFrame([("i1", item), ("i2", "only here")], "item_id string, text string")
    got = [drop_contaminated(docs, bench, index_bytes=size) for size in (1 << 25, 0)]
    assert all(g.columns == docs.columns for g in got)
    assert [sorted(r["tag"] for r in g.collect()) for g in got] == [["b", "d", "e", "f", "h"]] * 2


def test_samples_are_of_ids_and_bounded(spark):
    """One id with very many rows neither pushes a language out of the sample nor fills it."""
    from kestrel.llm import languages, quality

    en = [(1, "the house and the garden of the town", "en")] * 3000 + [(2, "all of the words are here", "en")]
    de = [(10 + i, f"der hund und die katze {i}", "de") for i in range(300)]
    model = languages.fit(spark.createDataFrame(en + de, "doc_id long, text string, lang string"))
    assert set(model.languages) == {"en", "de"}
    docs = spark.createDataFrame([(1, "same id " * 5)] * 2000 + [(i, f"text {i}") for i in range(2, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)] * 3, "doc_id long, quality int")
    seen = []
    train = quality.train
    quality.train = lambda x, y, *a, **k: seen.append(len(x)) or train(x, y, *a, **k)
    try:
        quality.fit(docs, labels, sample=30)
    finally:
        quality.train = train
    assert seen == [30]


def test_quality_query_on_held_out_documents(spark):
    from kestrel.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op8_quality_classifier"](spark, sf).collect()
    docs = {r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null").collect()}
    assert len(rows) == len(docs) and {r["doc_id"] for r in rows} == docs
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [(r["predicted"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    assert len(held) > 20 and sum(p == y for p, y in held) >= 0.9 * len(held)


def test_pipeline_carries_columns_named_like_helpers(spark, odd, none):
    import corpus_pipeline as cp

    names = ["_n", "_rank", "_kept", "_hit", "_letter", "__has_letter", "_n_lines", "_n_dropped", "bucket", "keys", "component_id", "item_id", "words", "shard"]
    docs = odd.select("*", *(F.lit(f"mine {c}").alias(c) for c in names))
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r["_b"] == 7 and r["fp"] == "k" and r["n_hit"] == 0 and all(r[c] == f"mine {c}" for c in names) for r in rows), name
    pack = cp.STAGES[-1][1]
    assert pack(spark, docs, SMALL).count() == pack(spark, odd, SMALL).count()
