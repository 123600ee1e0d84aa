"""Mixing sources to target weights with Efraimidis-Spirakis sampling.

Every document has a size (its words). Sources, in code point order with null last, weigh 5, 2,
1, repeating, and share ``budget`` (150%) of all sizes; a source's target stops at ``most`` (2) times
its size and what is over is reshared by weight. A source first takes as many whole epochs as fit
its target; for the rest, its documents get the key -ln(u) / w (u from a hash of the doc_id, w the
quality weight) and are taken in ascending order while the prefix sum of sizes stays nearest to
what is left. Reruns agree: nothing depends on partitions or on the time.

The quality weight comes from the text alone (``1 - 0.9 * share of symbols``), so neither sampling
nor :func:`mixed` has to move a text: a source's selection is a prefix in key order, described by
one cut, and the cut is found from sums over about sqrt(n) key ranges of the source plus the sorted
values of one range. No window sees more than about sqrt(n) rows of a source of n rows.

Rows that tie in key, doc_id and size are one value of a range. If the cut falls into one, as many of
its rows are taken as fit, in the order of a hash of the row; only then are the rows of that value
written once more and cut by ranges of that order. Among equal rows it does not matter which are taken.

Null texts have size 0 and weight 1; null doc_ids hash as the empty text; repeated rows are cut row by
row; empty tables give empty results; columns beside doc_id, text and source only order rows that tie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import WORD, documents, saved, whole

#: weights of the sources in turn (fixed values of the contract)
WEIGHTS = (5, 2, 1)
SYMBOLS = r"[!#*$%&|<>{}]+"


def _u(key: str) -> Column:
    """A number strictly between 0 and 1 from the first 52 bits of an md5."""
    h = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    return (F.conv(F.substring(h, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def quality_weight(text: str) -> Column:
    n = F.char_length(whole(text))
    kept = F.char_length(F.regexp_replace(whole(text), SYMBOLS, ""))
    return F.when(n == 0, F.lit(1.0)).otherwise(F.lit(0.1) + F.lit(0.9) * (kept / n))


def _keyed(docs: DataFrame) -> dict[str, Column]:
    return {"_mx_size": F.regexp_count(whole("text"), F.lit(WORD)).cast("long"),
            "_mx_key": -F.log(_u("doc_id")) / quality_weight("text")}


def _range_of(n: Column) -> Column:
    """Key range of a row: the unit interval of 1 - exp(-key) in ceil(sqrt(n)) parts."""
    parts = F.ceil(F.sqrt(n))
    return F.least(F.floor((F.lit(1.0) - F.exp(-F.col("_mx_key"))) * parts), parts - 1)


def source_targets(sized: DataFrame, weights=WEIGHTS, budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: source, _mx_n, source_size, target. The windows here run over one
    row per source, not over documents."""
    s = sized.groupBy("source").agg(F.count(F.lit(1)).alias("_mx_n"), F.sum("_mx_size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn % len(weights)) + 1))
    s = s.withColumn("cap", F.lit(most) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    total = F.lit(budget) * F.sum("source_size").over(every)
    rate = ((total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    s = s.withColumn("rate", rate).withColumn("full", F.col("rate") * F.col("w") > F.col("cap"))
    s = s.withColumn("rate", F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("w"), "rate"))).over(every)["rate"])
    return s.select("source", "_mx_n", "source_size",
                    F.when(F.col("full"), F.col("cap")).otherwise(F.least(F.col("rate") * F.col("w"), F.col("cap"))).alias("target"))


def _fitting() -> Column:
    """How many of _mx_tied equal rows fit after _mx_base: row i does if its middle is not past _mx_rest."""
    base, size, tied, rest = (F.col(c) for c in ("_mx_base", "_mx_size", "_mx_tied", "_mx_rest"))
    near = F.floor((rest - base) / size + F.lit(0.5))
    fits = lambda n: base + n * size - size / 2 <= rest
    near = F.when(fits(near + 1), near + 1).when(fits(near), near).otherwise(near - 1)
    return F.when(size > 0, F.greatest(F.lit(0), F.least(near, tied))).when(base <= rest, tied).otherwise(F.lit(0)).cast("long")


def plan(sized: DataFrame, **how) -> DataFrame:
    """One row per source: _mx_source, _mx_n, source_size, target, _mx_epochs (whole ones), and
    where the fractional selection ends: _mx_cut_range, _mx_cut (key, doc_id, size), the rows of that
    value (_mx_tied) and how many of them are taken (_mx_fit)."""
    t = saved(source_targets(sized, **how), "targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    t = t.withColumnRenamed("source", "_mx_source").withColumn("_mx_epochs", epochs)
    t = t.withColumn("_mx_rest", F.col("target") - F.col("_mx_epochs") * F.col("source_size"))
    rows = sized.join(t, F.col("source").eqNullSafe(F.col("_mx_source"))).drop("source")
    rows = rows.withColumn("_mx_range", _range_of(F.col("_mx_n")))
    sums = rows.groupBy("_mx_source", "_mx_range", "_mx_rest").agg(F.sum("_mx_size").alias("_mx_sum"))
    run = Window.partitionBy("_mx_source").orderBy("_mx_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_mx_base", F.coalesce(F.sum("_mx_sum").over(run), F.lit(0)))
    end = sums.where((F.col("_mx_base") < F.col("_mx_rest")) & (F.col("_mx_base") + F.col("_mx_sum") >= F.col("_mx_rest")))
    end = end.groupBy("_mx_source").agg(F.min(F.struct("_mx_range", "_mx_base")).alias("e"))
    end = saved(end.select(F.col("_mx_source").alias("_mx_s"), F.col("e._mx_range").alias("_mx_cut_range"),
                           F.col("e._mx_base").alias("_mx_base")), "ends")
    last = rows.join(end, F.col("_mx_source").eqNullSafe(F.col("_mx_s")) & (F.col("_mx_range") == F.col("_mx_cut_range")))
    last = last.groupBy("_mx_source", "_mx_rest", "_mx_base", "_mx_key", "doc_id", "_mx_size").agg(F.count(F.lit(1)).alias("_mx_tied"))
    before = (Window.partitionBy("_mx_source").orderBy("_mx_key", "doc_id", "_mx_size")
              .rowsBetween(Window.unboundedPreceding, -1))
    words = F.sum(F.col("_mx_size") * F.col("_mx_tied")).over(before)
    last = last.withColumn("_mx_base", F.col("_mx_base") + F.coalesce(words, F.lit(0))).withColumn("_mx_fit", _fitting())
    cut = (last.where("_mx_fit > 0").groupBy("_mx_source")
           .agg(F.max(F.struct("_mx_key", "doc_id", "_mx_size", "_mx_tied", "_mx_fit")).alias("c")))
    cut = cut.select(F.col("_mx_source").alias("_mx_s2"), F.struct("c._mx_key", "c.doc_id", "c._mx_size").alias("_mx_cut"),
                     "c._mx_tied", "c._mx_fit")
    out = t.join(end.drop("_mx_base"), F.col("_mx_source").eqNullSafe(F.col("_mx_s")), "left")
    out = out.join(cut, F.col("_mx_source").eqNullSafe(F.col("_mx_s2")), "left")
    return saved(out.drop("_mx_s", "_mx_s2", "_mx_rest"), "mix-plan")


def _copies(rows: DataFrame, how: DataFrame) -> DataFrame:
    """rows (with _mx_size, _mx_key) and the plan's columns, plus _mx_copies."""
    names = rows.columns
    rows = rows.join(how, F.col("source").eqNullSafe(F.col("_mx_source")))
    here = F.struct("_mx_key", "doc_id", "_mx_size")
    at = _range_of(F.col("_mx_n"))
    in_cut = (at == F.col("_mx_cut_range")) & F.col("_mx_cut").isNotNull()
    picked = F.coalesce((at < F.col("_mx_cut_range")) | (in_cut & (here <= F.col("_mx_cut"))), F.lit(False))
    copies = lambda df, taken: df.withColumn("_mx_copies", F.col("_mx_epochs") + taken.cast("long"))
    if how.where("_mx_fit < _mx_tied").isEmpty():
        return copies(rows, picked)
    split = F.coalesce(in_cut & (here == F.col("_mx_cut")) & (F.col("_mx_fit") < F.col("_mx_tied")), F.lit(False))
    return copies(rows.where(~split), picked).unionByName(copies(*_first_fitting(rows.where(split), names)).drop("_mx_first"))


def _first_fitting(tied: DataFrame, names: list[str]) -> tuple[DataFrame, Column]:
    """(the rows of values that the cut falls into, whether a row is among the first _mx_fit of its source).

    Their order is a range of the row's hash, the hash, a range of the row's place, the place; the last row
    taken is found from counts, so no window sees more than about sqrt(_mx_tied) rows and no text moves.
    """
    columns = tied.columns
    parts = F.ceil(F.sqrt("_mx_tied"))
    plain = [f.name for f in tied.select(*names).schema.fields if "map<" not in f.dataType.simpleString()]
    tied = saved(tied.withColumn("_mx_hash", F.xxhash64(*plain)).withColumn("_mx_place", F.monotonically_increasing_id())
                 .withColumn("_mx_part", F.pmod("_mx_hash", parts)).withColumn("_mx_salt", F.pmod(F.xxhash64("_mx_place"), parts)), "tied")
    group = ["_mx_source", "_mx_part", "_mx_hash", "_mx_salt"]
    groups = saved(tied.groupBy(*group, "_mx_fit").agg(F.count(F.lit(1)).alias("_mx_rows")), "tied-groups")
    earlier = lambda *by: Window.partitionBy(*by[0]).orderBy(*by[1]).rowsBetween(Window.unboundedPreceding, -1)
    ends = groups.groupBy("_mx_source", "_mx_part", "_mx_fit").agg(F.sum("_mx_rows").alias("_mx_rows"))
    ends = ends.withColumn("_mx_done", F.coalesce(F.sum("_mx_rows").over(earlier(["_mx_source"], ["_mx_part"])), F.lit(0)))
    here = (F.col("_mx_done") < F.col("_mx_fit")) & (F.col("_mx_done") + F.col("_mx_rows") >= F.col("_mx_fit"))
    ends = ends.where(here).select(F.col("_mx_source").alias("_mx_s3"), F.col("_mx_part").alias("_mx_p3"), "_mx_done")
    inside = groups.join(ends, F.col("_mx_source").eqNullSafe(F.col("_mx_s3")) & (F.col("_mx_part") == F.col("_mx_p3")))
    run = F.coalesce(F.sum("_mx_rows").over(earlier(["_mx_source"], ["_mx_hash", "_mx_salt"])), F.lit(0))
    inside = inside.withColumn("_mx_done", F.col("_mx_done") + run).where(here)
    last = F.struct(*group[1:], "_mx_place")
    inside = inside.select(F.col("_mx_source").alias("_mx_s4"), F.struct(*group[1:]).alias("_mx_g4"),
                           (F.col("_mx_fit") - F.col("_mx_done")).alias("_mx_need"))
    row = F.row_number().over(Window.partitionBy("_mx_source").orderBy("_mx_place"))
    ends = (tied.select(*group, "_mx_place")
            .join(inside, F.col("_mx_source").eqNullSafe(F.col("_mx_s4")) & (F.struct(*group[1:]) == F.col("_mx_g4")))
            .withColumn("_mx_row", row).where("_mx_row = _mx_need")
            .select(F.col("_mx_source").alias("_mx_s5"), last.alias("_mx_last")))
    tied = tied.join(saved(ends, "tied-ends"), F.col("_mx_source").eqNullSafe(F.col("_mx_s5")))
    return tied.select(*columns, (last <= F.col("_mx_last")).alias("_mx_first")), F.col("_mx_first")


def mix_report(docs: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    sized = docs.select("doc_id", "text", "source").withColumns(_keyed(docs)).drop("text")
    sized = saved(sized, "sized")
    out = _copies(sized, plan(sized, **how))
    return out.select("doc_id", F.col("_mx_size").alias("size"), "source_size", "target",
                      (F.col("_mx_copies") * F.col("_mx_size")).alias("taken"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, all columns unchanged; a document taken twice has two rows.
    The texts stay where they are: only the plan, one row per source, is joined to them."""
    names = docs.columns
    sized = saved(docs.select("doc_id", "text", "source").withColumns(_keyed(docs)).drop("text"), "sized")
    out = _copies(docs.withColumns(_keyed(docs)), plan(sized, **how))
    out = out.where("_mx_copies > 0").withColumn("_mx_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mx_copies"))))
    return out.select(*names)


def op7_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix_report(documents(spark, sf_dir).select("doc_id", "text", "source"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (CAST('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u,
    CASE WHEN length(coalesce(text, '')) = 0 THEN 1::DOUBLE ELSE 0.1::DOUBLE + 0.9::DOUBLE *
      (length(regexp_replace(text, '[!#*$%&|<>{}]+', '', 'g'))::DOUBLE / length(text)::DOUBLE) END AS w
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
        [5::DOUBLE, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS w
      FROM d GROUP BY source),
c AS (SELECT *, 2::DOUBLE * source_size AS cap FROM s),
r AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS rate
      FROM c WINDOW b AS (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, rate * w > cap AS is_full FROM r),
t AS (SELECT source, source_size, CASE WHEN is_full THEN cap
        ELSE least(first_value(rate) OVER (ORDER BY is_full, cap / w, source ASC NULLS LAST) * w, cap) END AS target FROM f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
k AS (SELECT d.*, e.source_size, e.target, e.epochs,
        sum(size) OVER (PARTITION BY d.source ORDER BY -ln(u) / d.w, doc_id, size ROWS UNBOUNDED PRECEDING) AS cum
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
  (size * (epochs + CASE WHEN cum - size / 2::DOUBLE <= target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM k
"""
