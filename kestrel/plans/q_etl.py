"""WL-ETL: the config-driven clean job and the cooking-time class report.

Recipes stand in as parts (FIXTURES part 3): name = p_name, ingredients =
name + type, cook time = PT<p_size>M, prep time = PT<p_partkey % 40>M.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import recipes
from kestrel.plans.config_job import JobConfig, run_job
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sources.tables import Tables

RECIPE_SCHEMA = "name string, ingredients string, cookTime string, prepTime string, datePublished string"

RECIPES_SQL = """
WITH recipes AS (
  SELECT p_name AS name, p_name || ' with ' || lower(p_type) AS ingredients,
         'PT' || CAST(p_size AS VARCHAR) || 'M' AS cookTime,
         'PT' || CAST(p_partkey % 40 AS VARCHAR) || 'M' AS prepTime,
         CAST(DATE '2020-01-01' + CAST(p_partkey % 30 AS INTEGER) AS DATE) AS datePublished,
         p_size + p_partkey % 40 AS m
  FROM part),
classed AS (
  SELECT (['easy', 'medium', 'hard'])[1 + CAST(m >= 30 AS INTEGER) + CAST(m > 60 AS INTEGER)] AS difficulty, m
  FROM recipes WHERE lower(ingredients) LIKE '%widget%')
"""


def recipes_from_parts(t: Tables):
    p = t.part
    return p.select(
        F.col("p_name").alias("name"),
        F.concat(F.col("p_name"), F.lit(" with "), F.lower("p_type")).alias("ingredients"),
        F.concat(F.lit("PT"), F.col("p_size").cast("string"), F.lit("M")).alias("cookTime"),
        F.concat(F.lit("PT"), (F.col("p_partkey") % 40).cast("string"), F.lit("M")).alias("prepTime"),
        F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("p_partkey") % 30).cast("int")),
                      "yyyy-MM-dd").alias("datePublished"))


def _task1(spark, sf) -> str:
    """Write the raw recipes as JSON, then run the clean job on them."""
    raw = scratch_path(spark, "recipes-json")
    recipes_from_parts(Tables(spark, sf)).write.mode("overwrite").json(raw)
    out = scratch_path(spark, "recipes-clean")
    ini = f"""[SectionETL]
input_file_path = {raw},
source_file_type = json
write_format = parquet
write_mode = overwrite
output_file_path = {out}
partition_col = datePublished
repartition =
"""
    return run_job(spark, JobConfig.from_ini(ini), [recipes.clean_names("name")], RECIPE_SCHEMA)


@query("etl_clean_job", RECIPES_SQL + """
SELECT translate(name, ', !)(''', '') AS name, ingredients, cookTime, prepTime, datePublished FROM recipes
""")
def etl_clean_job(spark, sf):
    """PIP-01 + SRC-01 + SNK-01 + STR-01: JSON in, names cleaned, Parquet
    out partitioned by publication date; the written table is read back."""
    return spark.read.parquet(_task1(spark, sf))


@query("etl_contains_class_avg", RECIPES_SQL + """
SELECT difficulty, CAST(sum(m) AS DOUBLE) / CAST(count(m) AS DOUBLE) AS avg_total_cooking_time
FROM classed GROUP BY difficulty
""")
def etl_contains_class_avg(spark, sf):
    """PIP-02 spec form: read task 1's output, keep recipes with the word,
    classify, average per class, write CSV with header (Q26), read back."""
    src = _task1(spark, sf)
    out = scratch_path(spark, "recipes-class-avg")
    ini = f"""[SectionETL]
input_file_path = {src}
source_file_type = parquet
write_format = csv
write_mode = overwrite
output_file_path = {out}
partition_col =
repartition =
"""
    steps = [recipes.contains_ci("ingredients", "widget"), recipes.with_total_minutes(),
             recipes.with_difficulty(), recipes.class_average()]
    path = run_job(spark, JobConfig.from_ini(ini), steps)
    return (spark.read.schema("difficulty string, avg_total_cooking_time double")
            .option("header", True).csv(path))


@query("etl_class_avg_rows", RECIPES_SQL + """
SELECT difficulty, avg(m) OVER (PARTITION BY difficulty) AS avg_total_cooking_time FROM classed
""")
def etl_class_avg_rows(spark, sf):
    """PIP-02 code form / WIN-03: the class average on every recipe row."""
    df = recipes_from_parts(Tables(spark, sf))
    for step in (recipes.contains_ci("ingredients", "widget"), recipes.with_total_minutes(),
                 recipes.with_difficulty(), recipes.class_average_rows()):
        df = df.transform(step)
    return df
