"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone.

A text is a bag of words weighted by their number.  For every word k and sample h the draws r, c ~ Gamma(2, 1) and
b ~ Uniform(0, 1) depend on (k, h) alone.  With weight S the word bids

    t = floor(ln S / r + b),    ln a = ln c - r (t - b) - r,

and the sample is the pair (k, t) of the least a.  Two texts draw the same pair with probability equal to their
generalised Jaccard similarity, the sum of the lesser weights over the sum of the greater.

A bid is packed into one long, the scaled ln a above 32 bits that name (k, t), so that a sample is the minimum of a long:
a hash aggregate with fixed-width buffers inside generated code.

The next document is found without a global window: quantiles of doc_id cut the rows into many ranges, and the head of
each range is dealt a second time, to the range before it.  Text is shuffled once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactlens.llm.text import BLANKS, WORD_GAP, read_table, whole_text

SAMPLES = 64
BLOCK = 8  # samples drawn in one aggregate; keeps generated code within what the JVM compiles
RANGES_PER_PARTITION = 8
_LOW = 0xFFFFFFFF


def _draw_logs(spark: SparkSession) -> DataFrame:
    """One row: minus the logarithm of each of the uniform draws of 13 bits; a look-up costs less than a logarithm."""
    one = F.struct("id", (F.lit(13 * math.log(2)) - F.log(F.col("id") + 0.5)).alias("log"))
    return spark.range(1 << 13).agg(F.sort_array(F.collect_list(one)).alias("_draws")).select(F.col("_draws.log").alias("_logs"))


def _bids(term: Column, number: Column, logs: list[Column]) -> list[Column]:
    """One packed bid for each weight's logarithm; null where the weight is 0.  Needs the column ``_logs``.

    One 64-bit hash gives five uniform draws; Gamma(2, 1) is minus the logarithm of the product of two.
    """
    draw = F.xxhash64(term, number)
    bits = lambda shift, n: F.shiftrightunsigned(draw, shift).bitwiseAND(F.lit((1 << n) - 1))
    log = lambda shift: F.get(F.col("_logs"), bits(shift, 13).cast("int"))
    r = log(0) + log(13)
    log_c = F.log(log(26) + log(39))
    b = (bits(52, 12).cast("double") + 0.5) * 2.0**-12
    out = []
    for log_weight in logs:
        t = F.floor(log_weight / r + b)
        # Above 0 for every draw, so that the floor is the whole part.
        height = F.floor((log_c - r * (t - b + 1.0) + 128.0) * float(1 << 23))
        out.append(F.shiftleft(height, 32).bitwiseOR(draw.bitwiseXOR(F.shiftleft(t, 16)).bitwiseAND(F.lit(_LOW))))
    return out


def signatures(rows: DataFrame, keys: list[str], texts: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` (one row each) and one array of ``samples`` longs for each column of ``texts``.

    A text without words has the empty word, once, so that all such texts agree.  When the rows are partitioned by one
    of the keys already, nothing is shuffled.
    """
    versions = F.posexplode(F.array(*[F.col(c) for c in texts])).alias("_version", "_text")
    one = rows.select(*keys, versions)
    # The text itself must not go along with every one of its words.
    one = one.select(*keys, "_version", (F.trim("_text", F.lit(BLANKS)) == "").alias("_blank"), F.split("_text", WORD_GAP).alias("_words"))
    one = one.select(*keys, "_version", "_blank", F.explode_outer("_words").alias("_word")).where((F.col("_word") != "") | F.col("_blank"))
    weights = [F.sum((F.col("_version") == i).cast("int")).alias(f"_n{i}") for i in range(len(texts))]
    bags = one.select(*keys, "_version", F.xxhash64("_word").alias("_term")).groupBy(*keys, "_term").agg(*weights)
    # A blank text may split into two empty words; its weight is 1 whatever the blanks.
    blank_term = F.xxhash64(F.lit(""))
    for i in range(len(texts)):
        n = F.col(f"_n{i}")
        bags = bags.withColumn(f"_n{i}", F.when(n == 0, None).when(F.col("_term") == blank_term, F.lit(0.0)).otherwise(F.log(n.cast("double"))))
    blocks = bags.withColumn("_block", F.explode(F.array(*[F.lit(i) for i in range(samples // BLOCK)])))
    blocks = blocks.crossJoin(F.broadcast(_draw_logs(rows.sparkSession)))
    drawn = []
    for j in range(BLOCK):
        number = F.col("_block") * BLOCK + j
        packed = _bids(F.col("_term"), number, [F.col(f"_n{i}") for i in range(len(texts))])
        drawn += [F.min(p).alias(f"_s{i}_{j}") for i, p in enumerate(packed)]
    least = blocks.groupBy(*keys, "_block").agg(*drawn)
    low = [F.array(*[F.col(f"_s{i}_{j}").bitwiseAND(F.lit(_LOW)) for j in range(BLOCK)]).alias(f"_a{i}") for i in range(len(texts))]
    parts = least.select(*keys, F.struct("_block", *low).alias("_part")).groupBy(*keys).agg(F.sort_array(F.collect_list("_part")).alias("_parts"))
    return parts.select(*keys, *[F.flatten(F.col(f"_parts._a{i}")).alias(f"{c}_signature") for i, c in enumerate(texts)])


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of samples two signatures have in common."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / float(samples)


def as_text(signature: Column) -> Column:
    return F.lower(F.concat_ws("", F.transform(signature, lambda x: F.lpad(F.hex(x), 8, "0"))))


def _range_of(key: Column, cuts: list[int]) -> Column:
    """Number of cuts below the key, by two short searches however many cuts there are; -1 for null."""
    if not cuts:
        return F.when(key.isNull(), -1).otherwise(0)
    width = max(1, math.isqrt(len(cuts)))
    groups = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    heads = F.split(F.lit(",".join(str(g[0]) for g in groups)), ",").cast("array<long>")
    lists = F.transform(F.split(F.lit(";".join(",".join(map(str, g)) for g in groups)), ";"), lambda g: F.split(g, ",").cast("array<long>"))
    group = F.size(F.filter(heads, lambda c: c < key))
    within = F.size(F.filter(F.get(lists, F.greatest(group - 1, F.lit(0))), lambda c: c < key))
    return F.when(key.isNull(), -1).when(group == 0, 0).otherwise((group - 1) * width + within)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) cut into ranges, each in descending doc_id, then text; null ids come last.

    Adds ``_range``, ``_row`` (place in the range), ``_ghost`` (the head of the next range, dealt a second time) and
    ``_next``, the text that follows; the last row is followed by the first.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = RANGES_PER_PARTITION * partitions
    shares = [i / wanted for i in range(1, wanted)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 20 * wanted).alias("cuts")).head()["cuts"] or []
    cuts = sorted(set(cuts))
    # The head of a range is its greatest id; one row for each range comes back, a number fixed by ``wanted``.
    heads = {r["_range"]: r["head"] for r in docs.select("doc_id", _range_of(F.col("doc_id"), cuts).alias("_range")).groupBy("_range").agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads, reverse=True)
    before = {order[(i + 1) % len(order)]: order[i] for i in range(len(order))}
    slots = range(-1, len(cuts) + 1)
    as_longs = lambda values: F.split(F.lit(",".join("" if v is None else str(v) for v in values)), ",")
    head = F.nullif(F.get(as_longs([heads.get(s) for s in slots]), F.col("_range") + 1), F.lit("")).cast("long")
    target = F.get(as_longs([before.get(s, s) for s in slots]), F.col("_range") + 1).cast("int")
    placed = docs.withColumn("_range", _range_of(F.col("doc_id"), cuts)).withColumn("_is_head", F.col("doc_id").eqNullSafe(head)).withColumn("_target", target)
    own = F.struct(F.col("_range").alias("range"), F.lit(False).alias("ghost"))
    ghost = F.struct(F.col("_target").alias("range"), F.lit(True).alias("ghost"))
    dealt = placed.withColumn("_place", F.explode(F.when(F.col("_is_head"), F.array(own, ghost)).otherwise(F.array(own))))
    dealt = dealt.select("doc_id", "text", F.col("_place.range").alias("_range"), F.col("_place.ghost").alias("_ghost"))
    dealt = dealt.repartition(4 * partitions, "_range")
    line = Window.partitionBy("_range").orderBy("_ghost", F.desc_nulls_last("doc_id"), "text")
    return dealt.withColumn("_row", F.row_number().over(line)).withColumn("_next", F.lead("text").over(line))


def edited_fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last floor(n_chars / 3) code points replaced by the first as many of the next document.
    Null texts are empty; a single document follows itself; rows of equal doc_id follow each other by text; repeated
    rows each give a row; an empty table gives none.  Columns other than doc_id and text are not looked at.
    """
    docs = documents.select("doc_id", whole_text().alias("text"))
    lined = with_next(docs)
    n = F.length("text")
    lined = lined.withColumn("_next", F.coalesce("_next", F.lit("")))
    lined = lined.withColumn("_edited", F.concat(F.expr("left(text, length(text) - int(floor(length(text) / 3)))"), F.expr("left(_next, int(floor(length(text) / 3)))")))
    lined = lined.select("_range", "_row", "_ghost", "doc_id", n.cast("long").alias("n_chars"), F.unhex(F.sha2("_edited", 256)).alias("_sha"), "text", "_edited")
    keys = ["_range", "_row", "_ghost", "doc_id", "n_chars", "_sha"]
    signed = signatures(lined, keys, ["text", "_edited"])
    line = Window.partitionBy("_range").orderBy("_row")
    signed = signed.withColumn("_after", F.lead("text_signature").over(line)).where(~F.col("_ghost"))
    return signed.select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("_sha")).alias("edited_sha256"),
        as_text(F.col("text_signature")).alias("fingerprint"),
        as_text(F.col("_edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("text_signature"), F.col("_edited_signature")).alias("near_edited"),
        likeness(F.col("text_signature"), F.col("_after")).alias("near_next"),
    )


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read_table(spark, sf_dir, "documents"))
