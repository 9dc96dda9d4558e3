"""Accuracy of extracted transactions against gold, field by field and macro-averaged."""

from __future__ import annotations

from random import Random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import similarity
from ..shared import written

EXACT = ("owner", "transaction_type", "asset_type", "transaction_date", "value_min", "value_max", "notification_date")
SIMILAR = ("asset_description", "filing_status", "sub_owner", "description")
SCORED = EXACT + SIMILAR
KINDS = ("digital", "scanned")


def exact_score(gold: Column, predicted: Column) -> Column:
    return gold.eqNullSafe(predicted).cast("double")


def similar_score(gold: Column, predicted: Column) -> Column:
    """Both null 1, one null 0, else the ratio; equal and null pairs skip the Python side."""
    plain = F.when(gold.eqNullSafe(predicted), F.lit(1.0)).when(gold.isNull() | predicted.isNull(), F.lit(0.0))
    asked = plain.isNull()
    return F.coalesce(plain, similarity(F.when(asked, gold), F.when(asked, predicted)))


def last_wins(rows: DataFrame, keys: list[str], position: str) -> DataFrame:
    """One row for each key, the one latest in position."""
    rest = [x for x in rows.columns if x not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), position).alias("r")).select(*keys, "r.*")


def line_scores(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Scores of each line on either side (doc_id, line_no, position, fields): a line that one side lacks scores 0."""
    g, p = (last_wins(x.select("doc_id", "line_no", "position", *SCORED), ["doc_id", "line_no"], "position") for x in (gold, predicted))
    both = g.alias("g").join(p.alias("p"), ["doc_id", "line_no"], "full_outer")
    here = F.col("g.position").isNotNull() & F.col("p.position").isNotNull()
    score = lambda f: (exact_score if f in EXACT else similar_score)(F.col(f"g.{f}"), F.col(f"p.{f}"))
    return both.select("doc_id", "line_no", *(F.when(here, score(f)).otherwise(F.lit(0.0)).alias(f) for f in SCORED))


def filing_scores(filings: DataFrame, lines: DataFrame) -> DataFrame:
    """doc_id, kind, field, score (long form): the mean over lines; a filing without lines on either side scores 1."""
    means = lines.groupBy("doc_id").agg(*(F.avg(f).alias(f) for f in SCORED))
    whole = filings.select("doc_id", "kind").join(means, "doc_id", "left")
    return whole.select("doc_id", "kind", *(F.coalesce(f, F.lit(1.0)).alias(f) for f in SCORED)).unpivot(["doc_id", "kind"], list(SCORED), "field", "score")


def gold_set_scores(scores: DataFrame, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """kind, field, score: means of filing means by kind (a kind without filings scores 1) and ``overall``."""
    unknown = ~F.col("kind").isin(*kinds)
    checked = scores.withColumn("kind", F.when(unknown, F.raise_error(F.concat(F.lit("unknown kind "), "kind"))).otherwise(F.col("kind")))
    rolled = checked.groupBy("field").agg(F.avg("score").alias("overall"), *(F.avg(F.when(F.col("kind") == k, F.col("score"))).alias(k) for k in kinds))
    fields = scores.sparkSession.createDataFrame([(f,) for f in SCORED], "field string")
    full = fields.join(rolled, "field", "left")
    return full.select("field", *(F.coalesce(k, F.lit(1.0)).alias(k) for k in (*kinds, "overall"))).unpivot("field", [*kinds, "overall"], "kind", "score")


def consistency(runs: DataFrame) -> DataFrame:
    """field, score: mean over pairs of runs (run, doc_id, line_no, position, fields) of the filing scores of one document.

    Pairs are of runs of the same document, a few each. The earlier run takes the gold side."""
    ids = runs.select("run", "doc_id").distinct()
    pairs = ids.alias("a").join(ids.alias("b"), (F.col("a.doc_id") == F.col("b.doc_id")) & (F.col("a.run") < F.col("b.run")))
    pairs = pairs.select(F.col("a.doc_id").alias("doc"), F.col("a.run").alias("first"), F.col("b.run").alias("second"), F.concat_ws("|", "a.doc_id", "a.run", "b.run").alias("doc_id"), F.lit("digital").alias("kind"))
    side = lambda which: runs.withColumnRenamed("doc_id", "doc").join(pairs.select("doc", F.col(which).alias("run"), "doc_id"), ["doc", "run"])
    scores = filing_scores(pairs, line_scores(side("first"), side("second")))
    return scores.groupBy("field").agg(F.avg("score").alias("score"))


def weakest(scores: DataFrame, n: int = 3) -> DataFrame:
    """The n lowest (field, score); ties in the order of the field list."""
    place = F.array_position(F.array(*map(F.lit, SCORED)), F.col("field"))
    return scores.withColumn("place", place).orderBy("score", "place").limit(n).drop("place")


def unequal_runs(runs: DataFrame) -> DataFrame:
    """doc_ids whose runs differ in any scored field."""
    digest = F.xxhash64("line_no", *SCORED)
    sums = runs.groupBy("doc_id", "run").agg(F.sort_array(F.collect_list(digest)).alias("lines"))
    return sums.groupBy("doc_id").agg(F.count_distinct("lines").alias("kinds")).where(F.col("kinds") > 1).select("doc_id")


def seeded_sample(ids: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """nth, id: the same n of the sorted ids (one column, repeats count each) as CPython draws from the sorted list for the
    seed, in the order of the draw; all of them, sorted, if there are no more.

    The driver draws n places among the number of ids; ids get their places by ranges: one sort, and the sizes of the
    ranges before."""
    spark, name = ids.sparkSession, ids.columns[0]
    ranged = ids.select(F.col(name).alias("id")).repartitionByRange("id").sortWithinPartitions("id").withColumn("at", F.monotonically_increasing_id())
    kept = written(ranged.select("id", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("at")), "sample-ids")
    sizes = kept.groupBy("part").count()
    before = F.sum("count").over(Window.orderBy("part")) - F.col("count")  # one row a range
    ranked = kept.join(F.broadcast(sizes.select("part", before.alias("before"))), "part").select((F.col("before") + F.col("at")).alias("place"), "id")
    total = kept.count()
    if n >= total:
        return ranked.select(F.col("place").alias("nth"), "id")
    drawn = [(k, place) for k, place in enumerate(Random(seed).sample(range(total), n))]
    return ranked.join(F.broadcast(spark.createDataFrame(drawn, "nth long, place long")), "place").select("nth", "id")


def report(scores: DataFrame) -> DataFrame:
    """field rows, one column a kind."""
    return scores.groupBy("field").pivot("kind").agg(F.first("score"))


def failures_by_kind(filings: DataFrame) -> DataFrame:
    """kind, filings, failed of filings (kind, error)."""
    return filings.groupBy("kind").agg(F.count("*").alias("filings"), F.count_if(F.col("error").isNotNull()).alias("failed"))


def determinism(filings: DataFrame, runs: DataFrame) -> DataFrame:
    """doc_id, same: whether two runs (rows of run 1 and 2) give a filing the same rows; null where the first run failed, false
    where only the second did. filings: (doc_id, first_error, second_error); a filing without rows has none in either run."""
    digest = F.xxhash64("line_no", *SCORED)
    lines = lambda run: F.sort_array(F.collect_list(F.when(F.col("run") == run, digest)))
    found = runs.groupBy("doc_id").agg(lines(1).alias("first"), lines(2).alias("second"))
    none = F.array().cast("array<bigint>")
    equal = F.coalesce("first", none) == F.coalesce("second", none)
    same = F.when(F.col("first_error").isNull(), F.col("second_error").isNull() & equal)
    return filings.join(found, "doc_id", "left").select("doc_id", same.alias("same"))


def report_json(scores: DataFrame, failures: DataFrame, checked: DataFrame | None = None, consistent: DataFrame | None = None) -> DataFrame:
    """One row (report): JSON of the scores (kind, field, score) by kind and overall, of filings and failures by kind, and, where
    they are given, of how many filings two runs agreed on (determinism's doc_id, same) and of fields between runs
    (consistency's field, score).

    All are a few rows whatever the corpus; scores of single filings go out as rows (``filing_scores``)."""
    entries = lambda key, value: F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value))))
    fields = scores.groupBy("kind").agg(entries("field", "score").alias("fields"))
    by_kind = fields.agg(F.map_from_arrays(F.collect_list("kind"), F.collect_list("fields")).alias("every"))
    counts = failures.select("kind", F.struct("filings", "failed").alias("n")).agg(F.map_from_arrays(F.collect_list("kind"), F.collect_list("n")).alias("errors"))
    joined, parts = by_kind.join(counts, F.lit(True)), []
    if checked is not None:
        told = F.struct(F.count("same").alias("checked"), F.count_if(~F.col("same")).alias("unequal"))
        joined, parts = joined.join(checked.agg(told.alias("determinism")), F.lit(True)), [*parts, "determinism"]
    if consistent is not None:
        joined, parts = joined.join(consistent.agg(entries("field", "score").alias("consistency")), F.lit(True)), [*parts, "consistency"]
    rest = F.map_filter("every", lambda k, _: k != "overall")
    return joined.select(F.to_json(F.struct(rest.alias("by_kind"), F.try_element_at("every", F.lit("overall")).alias("overall"), "errors", *parts)).alias("report"))
