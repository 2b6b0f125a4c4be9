"""Line dedup by distinct-site spread.

A line is boilerplate when it stands on at least ``sites`` different sites.  A HyperLogLog sketch of the sites is kept for
every line hash; sketches merge by aggregation, before and after the shuffle, so a line of a third of all documents costs
one small row per task.  Lines whose estimate lies near the threshold get an exact distinct count.  Boilerplate lines go
from every document on every site, however much of the document they are.

A text that stands whole on as many sites keeps its lines: it is a copied document, which is the near-duplicate operator's
business, and would else be lost with all its copies.  Whole texts are counted as lines are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.llm.text import BLANKS, read_table, whole_text
from pactlens.session import materialize

SITES = 10
SKETCH_BITS = 12
#: Six standard errors of a sketch of 2^12 registers (1.6 % each).
NEAR = 0.1
#: The place that stands for the whole text.
WHOLE = -1


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _keys() -> list[Column]:
    return [F.xxhash64("id", "text").alias("k1"), F.xxhash64("text", "id").alias("k2")]


def line_rows(docs: DataFrame) -> DataFrame:
    """From (id, text, site): (k1, k2, pos, line, site) of every line that is not blank, and of the whole text at ``WHOLE``; ``line`` is
    a hash of the trimmed line, and rows of equal id and text share the keys."""
    body = lambda x: F.trim(x, F.lit(BLANKS))
    hashes = F.transform(_lines(F.col("text")), lambda x: F.when(body(x) != "", F.xxhash64(body(x))))
    rows = docs.select(*_keys(), "site", F.posexplode(F.array_prepend(hashes, F.xxhash64(F.lit("whole"), "text"))).alias("pos", "line"))
    return rows.where("line is not null").select("k1", "k2", (F.col("pos") + WHOLE).alias("pos"), "line", "site")


def boilerplate(lines: DataFrame, sites: int = SITES, near: float = NEAR) -> DataFrame:
    """Hashes of the lines on at least ``sites`` distinct sites; rows without a site do not count."""
    spread = lines.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch"))
    spread = spread.select("line", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= sites * (1 - near))
    spread = materialize(spread, "line-spread")
    close = spread.where(F.col("sites") <= sites * (1 + near)).select("line")
    exact = lines.where("site is not null").select("line", "site").join(close, "line", "left_semi").distinct()
    exact = exact.groupBy("line").count().where(F.col("count") >= sites).select("line")
    return materialize(spread.where(F.col("sites") > sites * (1 + near)).select("line").unionByName(exact), "boilerplate")


def drop_boilerplate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", site_column: str = "source", sites: int = SITES) -> DataFrame:
    """For every row of ``docs``: ``row`` (the row as a struct), ``n_lines``, ``n_removed`` and ``kept``, the text without
    boilerplate lines.

    Null text is empty; a text of nothing but boilerplate becomes empty, if it does not stand whole on ``sites`` sites; blank lines and what stays are not changed; rows of equal id and text are treated alike; a null
    site is no site; an empty table gives no rows.
    """
    packed = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("id"), whole_text(text_column).alias("text"), F.col(site_column).cast("string").alias("site"))
    lines = line_rows(packed.select("id", "text", "site"))
    gone = lines.join(boilerplate(lines, sites), "line").select("k1", "k2", "pos").distinct()
    gone = gone.groupBy("k1", "k2").agg(F.collect_list("pos").alias("gone"))
    marked = packed.select("row", "text", *_keys()).join(materialize(gone, "lines-gone"), ["k1", "k2"], "left")
    marked = marked.withColumn("gone", F.when(~F.array_contains("gone", WHOLE), F.col("gone")))
    stays = F.filter(_lines(F.col("text")), lambda _, i: ~F.array_contains("gone", i))
    return marked.select(
        "row",
        F.size(_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(stays, "\n")).alias("kept"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = drop_boilerplate(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return done.select("row.doc_id", "n_lines", "n_removed", F.col("kept").alias("text"))


_TRIM = "trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
OP3_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, source, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
t AS (SELECT r, pos, source, line, {_TRIM} AS body FROM l),
b AS (SELECT body FROM t WHERE body <> '' GROUP BY body HAVING count(DISTINCT source) >= {SITES}),
w AS (SELECT text FROM documents GROUP BY text HAVING count(DISTINCT source) >= {SITES}),
c AS (SELECT r FROM d JOIN w ON lines = string_split(coalesce(w.text, ''), chr(10))),
g AS (SELECT r, pos, line, body IN (SELECT body FROM b) AND r NOT IN (SELECT r FROM c) AS goes FROM t),
k AS (SELECT r, count(*) AS n_lines, count(*) FILTER (goes) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT goes), '') AS text FROM g GROUP BY r)
SELECT doc_id, n_lines, n_removed, text FROM k JOIN d USING (r)
"""
