"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import WORD, clean_text, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
ROWS_PER_BUCKET = 50_000
HASHES = 1 << 32


def source_targets(
    sized: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """One row per source: sid, rows, source_size, weight, target, and the total budget.

    Sources in code-point order, null last, weigh `weights` in turn and share `share`
    times all sizes; a target is at most `most` times its source, what is over goes to
    the others by weight. That is a water level: with sources ordered by cap / weight,
    the level is (budget - caps before) / (weights from here on) at the first source
    whose own ratio is not below it. One row per source is all that meets in one task.
    """
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    each = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
        .withColumn("sid", F.row_number().over(rank))
        .withColumn(
            "weight",
            F.element_at(
                F.array(*[F.lit(w) for w in weights]),
                F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1,
            ).cast("double"),
        )
        .withColumn("cap", (F.col("source_size") * most).cast("double"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    whole = Window.partitionBy()
    upto = Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, 0)
    each = (
        each.withColumn("all_size", F.sum("source_size").over(whole))
        .withColumn("budget", F.col("all_size") * F.lit(float(share)))
        .withColumn("caps_before", F.sum("cap").over(upto) - F.col("cap"))
        .withColumn(
            "weights_left",
            F.sum("weight").over(whole) - F.sum("weight").over(upto) + F.col("weight"),
        )
        .withColumn("level", (F.col("budget") - F.col("caps_before")) / F.col("weights_left"))
        .withColumn("k", F.row_number().over(Window.orderBy("ratio", "sid")))
    )
    fits = F.when(F.col("level") <= F.col("ratio"), F.col("k"))
    return each.withColumn(
        "water", F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")), fits).over(whole)
    ).select(
        "source",
        "sid",
        "rows",
        "source_size",
        F.least("cap", F.col("water") * F.col("weight")).alias("target"),
        F.floor("budget").cast("bigint").alias("budget"),
        F.sum("rows").over(whole).alias("all_rows"),
    )


def mix(sized: DataFrame, seed: str = "mix", most: int = MOST, **targets) -> DataFrame:
    """Which rows a mix takes; `sized` has doc_id, source, size.

    Each source is shuffled by a hash of doc_id anew in each of `most` rounds, and its
    rows get a virtual finish time: words of the source so far / target of the source.
    Rows of all sources in order of that time are taken until the total budget is
    reached; the row that meets it is taken in part.

    Sums run in two levels, so neither a source nor the whole is ever sorted in one
    task: rows of a source are dealt into ranges of the hash and all rows into ranges of
    virtual time, each of about ROWS_PER_BUCKET rows; sums of ranges are small tables.

    Returns one row per input row: doc_id, size, source, source_size, target, taken
    (words, repeats counted) and copies (rounds in which it is taken whole). Rows of
    size 0 are never taken; equal rows are counted, numbered and treated one by one.
    """
    targets_of = source_targets(sized, most=most, **targets)
    counted = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("_m"))
    known = (
        counted.withColumn("_dup", F.explode(F.sequence(F.lit(1), F.col("_m"))))
        .drop("_m")
        .alias("d")
        .join(
            targets_of.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))
        )
        .select("d.*", "sid", "rows", "source_size", "target", "budget", "all_rows")
    )
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    hashed = (
        known.where(F.col("size") > 0)
        .withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(most)])))
        .withColumn("h", F.md5(F.concat_ws(":", F.lit(seed), F.col("epoch").cast("string"), text_id)))
        .withColumn("u", F.conv(F.substring("h", 1, 8), 16, 10).cast("bigint"))
        .withColumn("_parts", F.ceil(F.col("rows") / F.lit(ROWS_PER_BUCKET)).cast("bigint"))
        .withColumn(
            "_bucket",
            F.col("epoch") * F.col("_parts")
            + F.floor(F.col("u") * F.col("_parts") / F.lit(HASHES)).cast("bigint"),
        )
    )
    order = ["epoch", "u", "h", "doc_id", "size", "_dup"]
    finished = (
        _running(hashed, ["sid"], "_bucket", order, "so_far")
        .withColumn("finish", F.col("so_far") / F.col("target"))
        .withColumn(
            "_times", F.ceil(F.col("all_rows") * most / F.lit(ROWS_PER_BUCKET)).cast("bigint")
        )
        .withColumn("_time", _range_of(F.col("finish"), F.col("_times")))
    )
    queue = ["finish", "sid", *order]
    cut = _running(finished, [], "_time", queue, "served")
    whole = F.least(F.col("size"), F.greatest(F.lit(0), F.col("budget") - F.col("served") + F.col("size")))
    taken = cut.withColumn("_taken", whole.cast("bigint"))
    per_row = taken.groupBy("doc_id", "sid", "size", "_dup").agg(
        F.sum("_taken").alias("taken"),
        F.sum((F.col("_taken") == F.col("size")).cast("int")).alias("copies"),
    )
    same = (
        F.col("k.doc_id").eqNullSafe(F.col("t.doc_id"))
        & (F.col("k.sid") == F.col("t.sid"))
        & (F.col("k.size") == F.col("t.size"))
        & (F.col("k._dup") == F.col("t._dup"))
    )
    return (
        known.alias("k")
        .join(per_row.alias("t"), same, "left")
        .select(
            "k.doc_id",
            "k.size",
            "k.source",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
            F.coalesce("copies", F.lit(0)).cast("int").alias("copies"),
            F.col("k._dup").alias("copy_no"),
        )
    )


def _range_of(finish: Column, times: Column) -> Column:
    """Number of the range of a finish time; later times never have smaller numbers.

    There are `times` ranges up to 1, as many from 1 to 2, from 2 to 4 and so on. All sources
    together serve at most as fast later on as before, so up to 2^k there are as many rows as
    from there to 2^(k+1) at least, and each range holds about all rows / `times` at most.
    """
    k = F.floor(F.log2(F.greatest(finish, F.lit(1.0))))
    later = F.floor((finish / F.pow(F.lit(2.0), k) - 1) * times) + (k + 1) * times
    return F.when(finish < 1, F.floor(finish * times)).otherwise(later).cast("bigint")


def _running(
    frame: DataFrame, keys: list[str], bucket: str, order: list[str], name: str
) -> DataFrame:
    """Running sum of `size` per `keys` in order of (bucket, order), in two levels."""
    sums = frame.groupBy(*keys, bucket).agg(F.sum("size").alias("_sum"))
    before = sums.withColumn(
        "_before",
        F.sum("_sum").over(Window.partitionBy(*keys).orderBy(bucket)) - F.col("_sum"),
    ).drop("_sum")
    here = (
        Window.partitionBy(*keys, bucket)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        frame.withColumn("_in", F.sum("size").over(here))
        .join(before, [*keys, bucket])
        .withColumn(name, F.col("_before") + F.col("_in"))
        .drop("_before", "_in")
    )


def words_of(column: str = "text") -> Column:
    return F.regexp_count(clean_text(column), F.lit(WORD)).cast("bigint")


def mix_documents(documents: DataFrame, **options) -> DataFrame:
    """The mix of `documents` (doc_id, text, source); sizes are words of the text, null is 0.

    Texts are read once: their sizes are stored, and the mix works on these.
    """
    sized = documents.select("doc_id", "source", words_of().alias("size"))
    return mix(stored(sized, "mix-sizes"), **options)


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as often as the mix takes it whole; same columns.

    A row that the budget cuts in part is left out, as half a document is none. Equal
    (doc_id, source, size) rows are numbered to meet their own decision.
    """
    dup = Window.partitionBy("doc_id", "source", "size").orderBy(F.xxhash64("_row.text"))
    left = documents.select(
        F.struct(*documents.columns).alias("_row"), "doc_id", "source", words_of().alias("size")
    ).withColumn("_no", F.row_number().over(dup))
    sized = stored(documents.select("doc_id", "source", words_of().alias("size")), "mix-sizes")
    chosen = mix(sized, **options).where("copies > 0")
    same = (
        F.col("l.doc_id").eqNullSafe(F.col("c.doc_id"))
        & F.col("l.source").eqNullSafe(F.col("c.source"))
        & (F.col("l.size") == F.col("c.size"))
        & (F.col("l._no") == F.col("c.copy_no"))
    )
    return (
        left.alias("l")
        .join(chosen.alias("c"), same)
        .withColumn("_round", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("_row.*")
    )


SQL = rf"""
with sized as (
  select doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
numbered as (
  select *, row_number() over (partition by doc_id, source, size) as dup from sized),
ranked as (
  select source, sum(size)::bigint as source_size, count(*) as n,
    row_number() over (order by source asc nulls last) as sid
  from sized group by source),
weighted as (
  select *, ([3, 1, 2])[((sid - 1) % 3) + 1]::double as weight,
    (source_size * 2)::double as cap from ranked),
levels as (
  select *, cap / weight as ratio,
    (sum(source_size) over ()) * 1.5::double as budget,
    sum(cap) over (order by cap / weight, sid
      rows between unbounded preceding and current row) - cap as caps_before,
    (sum(weight) over ()) - sum(weight) over (order by cap / weight, sid
      rows between unbounded preceding and current row) + weight as weights_left
  from weighted),
water as (
  select arg_min((budget - caps_before) / weights_left, (ratio, sid)) as level
  from levels where (budget - caps_before) / weights_left <= ratio),
targets as (
  select source, sid, source_size, least(cap, level * weight) as target,
    floor(budget)::bigint as budget from levels, water),
entries as (
  select d.*, t.sid, t.target, t.budget, e.epoch,
    md5('mix:' || e.epoch::varchar || ':' || coalesce(d.doc_id::varchar, '')) as h
  from numbered d join targets t on d.source is not distinct from t.source,
    (values (0), (1)) e(epoch)
  where d.size > 0),
timed as (
  select *, (sum(size) over (partition by sid order by epoch, h, doc_id, size, dup
    rows between unbounded preceding and current row))::bigint / target as finish from entries),
served as (
  select *, sum(size) over (order by finish, sid, epoch, h, doc_id, size, dup
    rows between unbounded preceding and current row)::bigint as served from timed),
taken as (
  select doc_id, sid, size, dup,
    sum(least(size, greatest(0, budget - served + size)))::bigint as taken,
    sum((served <= budget)::int)::int as copies
  from served group by all)
select d.doc_id, d.size, d.source, t.source_size, t.target,
  coalesce(k.taken, 0)::bigint as taken, coalesce(k.copies, 0)::int as copies, d.dup as copy_no
from numbered d
join targets t on d.source is not distinct from t.source
left join taken k on d.doc_id is not distinct from k.doc_id and t.sid = k.sid
  and d.size = k.size and d.dup = k.dup
"""
