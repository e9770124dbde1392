"""Type 2 history of one tracked column, three ways.

* :func:`timeline` builds the whole history from dated rows in one pass.
* :func:`merge` folds one dated batch into an existing history.
* :func:`rebuild_late` recomputes the history of keys that received a batch
  older than their newest version.

Bulk and merge differ on dirty input (NULL prices, several rows of one id in a
day, rows without a city). That is intended; see README.

Skew. A key may own any share of the input. ``timeline`` first keeps one row
per key and day; Spark limits each map task to one row per group before that
shuffle, and afterwards a key has at most one row per snapshot date, so the
window over a key is bounded by the calendar. ``merge`` decides on counted
(id, price) pairs and joins the wide rows once against unique pairs, which
leaves AQE free to split a hot id.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listing_lake import rules, schemas
from listing_lake.functions import cleaning
from listing_lake.session import stored

# Incompressible texts that follow from another column. Exchanges do without them.
DERIVED = {"url_hash": ("page_url", cleaning.url_digest)}

BULK_KEYS = ("city", "property_id")
MERGE_KEYS = ("property_id",)

# How often a version is kept that several rows of a batch end.
ONCE, PER_MATCH = "once", "per_match"
# Copies of one row that are unfolded at a time.
PORTION = 10_000
# Rows of one task of a history that is laid out by city.
PART_ROWS = 500_000


# ---------------------------------------------------------------- enrichment


def only_traded(silver: DataFrame) -> DataFrame:
    """Rows that some Gold table takes, with ``table_name`` added."""
    traded = silver.filter(F.col("purpose").isin(*rules.GOLD_TABLES))
    if "table_name" in traded.columns:  # as it is: what was distributed by it stays so
        return traded
    return traded.withColumn("table_name", cleaning.gold_table(F.col("purpose")))


def lean(rows: DataFrame) -> DataFrame:
    """The rows without what :func:`restored` can derive anew, so that exchanges move less."""
    return rows.drop(*[name for name, (source, _) in DERIVED.items() if source in rows.columns])


def restored(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns of rows that :func:`lean` has made narrower, derived ones included."""
    lost = [name for name in columns if name in DERIVED and name not in rows.columns]
    return rows.withColumns({n: DERIVED[n][1](F.col(DERIVED[n][0])) for n in lost}).select(*columns)


def enrich(silver: DataFrame, loaded_at: str, valid_from: Column) -> DataFrame:
    """Add the Gold-only columns, as an open version starting at ``valid_from``."""
    return graded(silver, loaded_at).withColumns(
        {
            "is_current": F.lit(True),
            "valid_from": valid_from.cast("date"),
            "valid_to": F.lit(None).cast("date"),
        }
    )


def graded(silver: DataFrame, loaded_at: str) -> DataFrame:
    """Add the Gold-only columns that do not depend on other rows."""
    return silver.withColumns(
        {
            "property_category": cleaning.property_category(
                F.col("bedrooms"), F.col("property_type")
            ),
            "is_anomaly": cleaning.is_anomaly(F.col("price"), F.col("purpose")),
            "_gold_loaded_at": F.lit(loaded_at),
        }
    )


def conform(df: DataFrame, *extra: str) -> DataFrame:
    """The Gold columns in order and type, then ``extra``."""
    return df.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in schemas.GOLD],
        *extra,
    )


def has_city(df: DataFrame) -> DataFrame:
    return df.filter(F.col("city").isNotNull() & (F.col("city") != ""))


def row_tie_break(silver: DataFrame) -> list[str | Column]:
    """Total order among rows of one id and day: arrival, then content."""
    content = [c for c in silver.columns if c != "_ingested_at"]
    return ["_ingested_at", F.xxhash64(*content), "page_url", "price"]


# ------------------------------------------------------------ bulk timeline


def one_per_day(
    df: DataFrame, keys: Sequence[str], date: str, tie_break: Sequence[str | Column]
) -> DataFrame:
    ranked = Window.partitionBy(*keys, date).orderBy(*tie_break)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def change_points(
    daily: DataFrame, keys: Sequence[str], date: str, tracked: str
) -> DataFrame:
    """Rows whose tracked value differs from the row before, NULL-aware as SQL is.

    A NULL value after a known one is no change; the row after a NULL always is.
    """
    by_key = Window.partitionBy(*keys).orderBy(date)
    return (
        daily.withColumn("_before", F.lag(tracked).over(by_key))
        .filter(F.col("_before").isNull() | (F.col(tracked) != F.col("_before")))
        .drop("_before")
    )


def close_versions(points: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Each version lasts until the next one of its key begins."""
    by_key = Window.partitionBy(*keys).orderBy(date)
    return points.withColumn("valid_to", F.lead(date).over(by_key)).withColumns(
        {"valid_from": F.col(date), "is_current": F.col("valid_to").isNull()}
    )


def timeline(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    tracked: str,
    tie_break: Sequence[str | Column],
) -> DataFrame:
    """Whole history of ``tracked`` per key: two exchanges, whatever the key sizes."""
    daily = one_per_day(df, keys, date, tie_break)
    return close_versions(change_points(daily, keys, date, tracked), keys, date)


def bulk_history(
    silver: DataFrame,
    loaded_at: str,
    keys: Sequence[str] = BULK_KEYS,
    date: str = "snapshot_date",
    tie_break: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Gold rows of all tables (with ``table_name``) from dated Silver rows."""
    return _history_of(_bulk_rows(silver, date), silver, loaded_at, keys, date, tie_break)


def _bulk_rows(silver: DataFrame, date: str) -> DataFrame:
    return only_traded(has_city(silver.filter(F.col(date).isNotNull())))


def _history_of(
    rows: DataFrame,
    silver: DataFrame,
    loaded_at: str,
    keys: Sequence[str],
    date: str,
    tie_break: Sequence[str | Column] | None,
    deal: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The history of ``rows``; ``deal`` distributes them by a column ``_part``, else the keys do."""
    order = row_tie_break(silver) if tie_break is None else tie_break
    # columns that move anyway are no copies
    named = [c if isinstance(c, str) and c not in DERIVED else f"_tie_{n}" for n, c in enumerate(order)]
    ties = {t: F.col(c) if isinstance(c, str) else c for t, c in zip(named, order) if t is not c}
    # what all the columns decide is settled before the rows are made narrow
    narrow = lean(rows.withColumns(ties))
    # the table last: sorts tell rows apart sooner, and rows of one id in both tables meet
    by = (*keys, "table_name")
    if deal is not None:
        narrow, by = deal(narrow), ("_part", *by)
    history = timeline(narrow, by, date, "price", named).drop(*ties)
    whole = restored(history, [*rows.columns, "valid_from", "valid_to", "is_current"])
    return conform(graded(whole, loaded_at), "table_name")


def bulk_history_by_city(
    silver: DataFrame, loaded_at: str, tie_break: Sequence[str | Column] | None = None
) -> DataFrame:
    """The rows of :func:`bulk_history`, each task holding few cities: ready to be written by city.

    The wide rows move once, all rows of a key to one task. Rows are counted by key
    first, on the key columns alone. The counts lay the cities out side by side, each as
    long as it has rows and its keys spread over that length, and equal lengths are the
    parts; so a city of any size takes as many parts as it needs. Keys with more rows
    than a part go the way of ``bulk_history``, which bounds them by the calendar.
    """
    keys, date = BULK_KEYS, "snapshot_date"
    rows = _bulk_rows(silver, date)
    counted = stored(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")))
    total = counted.agg(F.sum("_rows")).first()[0] or 0
    length = max(1, min(PART_ROWS, -(-total // rows.sparkSession.sparkContext.defaultParallelism)))
    # one row for each city, as there is one folder for each
    length_of = counted.groupBy("city").agg(F.sum("_rows").alias("_rows"))
    start = F.sum("_rows").over(Window.orderBy("city")) - F.col("_rows")
    cities = F.broadcast(length_of.withColumn("_start", start))
    place = F.col("_start") + F.pmod(F.xxhash64(*keys), F.col("_rows"))

    def deal(narrow: DataFrame) -> DataFrame:
        placed = narrow.join(cities, "city").withColumn("_part", F.floor(place / length).cast("int"))
        return placed.drop("_rows", "_start").repartitionById(max(1, -(-total // length)), "_part")

    # fewer than there are parts
    hot = counted.filter(F.col("_rows") > length).select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
    if hot.isEmpty():
        return _history_of(rows, silver, loaded_at, keys, date, tie_break, deal)
    same, hot = F.lit(True), F.broadcast(hot)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_hot_{k}"))
    return _history_of(
        rows.join(hot, same, "left_anti"), silver, loaded_at, keys, date, tie_break, deal
    ).unionByName(
        _history_of(rows.join(hot, same, "left_semi"), silver, loaded_at, keys, date, tie_break)
    )


# ------------------------------------------------------------ daily merge


def current_rows(gold: DataFrame) -> DataFrame:
    return gold.filter("is_current")


def closed_rows(gold: DataFrame) -> DataFrame:
    return gold.filter("NOT coalesce(is_current, false)")


def incoming_versions(silver: DataFrame, file_date: Column, loaded_at: str, *extra: str) -> DataFrame:
    """One batch of Silver rows as candidate versions (with ``table_name``, and ``extra``)."""
    return conform(enrich(only_traded(silver), loaded_at, file_date), "table_name", *extra)


#: The columns of a version that merges change.
LIFETIME = ("is_current", "valid_from", "valid_to", "_gold_loaded_at")


def described(versions: DataFrame, rows: DataFrame, row_id: str) -> DataFrame:
    """The columns of ``rows``, with the lifetimes of the narrow versions that name them by ``row_id``."""
    columns = [c for c in rows.columns if c != row_id]
    lives = versions.select(row_id, *LIFETIME)
    return restored(lean(rows.drop(*LIFETIME)).join(lives, row_id), columns)


def _expiring_pairs(
    open_pairs: DataFrame, incoming: DataFrame, ids: list[str], tracked: str
) -> DataFrame:
    """(id, value) pairs that the batch ends, with the number of rows ending them.

    An open value is ended once by every batch row of its id that has another
    value: all known values of the id, less those equal to the open one.
    """
    pair = [*ids, tracked]
    same = (
        incoming.select(*pair).dropna().groupBy(*pair).agg(F.count(F.lit(1)).alias("_same"))
    )
    known = same.groupBy(*ids).agg(F.sum("_same").alias("_known"))
    return (
        open_pairs.join(known, ids)
        .join(same, pair, "left")
        .withColumn("_copies", F.col("_known") - F.coalesce("_same", F.lit(0)))
        .filter("_copies > 0")
        .select(*pair, "_copies")
    )


def end_versions(
    rows: DataFrame, columns: list[str], day: Column, loaded_at: str, copies: str
) -> DataFrame:
    """Closes the rows that ``_copies`` batch rows end (NULL: none) at ``day``."""
    if copies not in (ONCE, PER_MATCH):
        raise ValueError(f"copies must be per_match or once, not {copies!r}")
    closing = {
        "is_current": F.lit(False),
        "valid_to": day.cast("date"),
        "_gold_loaded_at": F.lit(loaded_at),
    }
    ended = F.col("_copies").isNotNull()
    judged = rows.withColumns(
        {name: F.when(ended, value).otherwise(F.col(name)) for name, value in closing.items() if name in columns}
    )
    if copies == PER_MATCH:
        left = F.col("_copies") - F.col("_from")
        judged = (
            judged.withColumn("_copies", F.coalesce("_copies", F.lit(1)).cast("long"))
            .withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(PORTION).cast("long"))))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least(left, F.lit(PORTION)).cast("int"))))
        )
    return judged.select(*columns)


def merge_open(
    open_versions: DataFrame,
    incoming: DataFrame,
    file_date: Column,
    loaded_at: str,
    ids: Sequence[str] = MERGE_KEYS,
    tracked: str = "price",
    copies: str = ONCE,
) -> DataFrame:
    """Open versions after one batch, together with the versions it has closed.

    * an open version whose id comes back with another value is closed at
      ``file_date``, once in all, or with ``copies="per_match"`` once per such
      batch row, what an inner join gives;
    * a batch row whose (id, value) is not open yet becomes a new version;
      NULL ids and NULL values equal nothing, so they always do;
    * everything else stays as it is.
    """
    ids = list(ids)
    pair = [*ids, tracked]
    open_pairs = open_versions.select(*pair).dropna().distinct()
    expiring = _expiring_pairs(open_pairs, incoming, ids, tracked)
    narrow = lean(open_versions)
    judged = end_versions(narrow.join(expiring, pair, "left"), narrow.columns, file_date, loaded_at, copies)
    new = lean(incoming).join(open_pairs, pair, "left_anti").select(*narrow.columns)
    return restored(judged.unionByName(new), open_versions.columns)


def merge(
    gold: DataFrame,
    incoming: DataFrame,
    file_date: Column,
    loaded_at: str,
    ids: Sequence[str] = MERGE_KEYS,
    tracked: str = "price",
    copies: str = ONCE,
) -> DataFrame:
    """Full history after one batch; closed versions bypass every join."""
    return closed_rows(gold).unionByName(
        merge_open(current_rows(gold), incoming, file_date, loaded_at, ids, tracked, copies)
    )


# ------------------------------------------------------------ many batches in one pass


def _lifetimes(
    open_pairs: DataFrame, incoming: DataFrame, ids: list[str], tracked: str, steps: list[str]
) -> DataFrame:
    """Which (id, value) a batch opens, when it ends, and how many rows end it.

    The merge rule on one id, step by step: a batch whose rows all have one known
    value leaves just that value open; a batch with several ends all that is open
    and opens those of its values that were not. So a value that comes in every
    step of a run is open after the first one, stays so over steps that have it
    alone, and turns at each step that has others too: what is open is told by
    counting within runs. All windows work on counted rows, one for each value
    and step of an id, and share one exchange.
    """
    pair = [*ids, tracked]
    counted = incoming.dropna(subset=pair).groupBy(*pair, *steps).agg(
        F.count(F.lit(1)).alias("_n"), F.max("valid_from").alias("_day")
    )
    started = open_pairs.withColumn("_batch", F.lit(0)).unionByName(
        counted.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    of_step = Window.partitionBy(*ids, "_step")
    whole_step = of_step.orderBy(tracked).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = (
        started.withColumn("_step", F.struct("_batch", *steps))
        .repartition(*ids)
        .withColumns({"_all": F.sum("_n").over(of_step), "_values": F.count(F.lit(1)).over(of_step)})
        .withColumns(
            {
                "_seq": F.dense_rank().over(Window.partitionBy(*ids).orderBy("_step")),
                "_next": F.lead(F.struct("_day", "_all")).over(Window.partitionBy(*ids).orderBy("_step", tracked)),
            }
        )
        # right on the last row of a step, so handed to all of them
        .withColumn("_next", F.last("_next").over(whole_step))
        .withColumn("_alone", (F.col("_batch") == 0) | (F.col("_values") == 1))
    )
    by_value = Window.partitionBy(*pair).orderBy("_seq")
    run = Window.partitionBy(*pair, "_run")
    later = run.orderBy(F.desc("_seq"))
    gap = F.coalesce(F.col("_seq") != F.lag("_seq").over(by_value) + 1, F.lit(True))
    turn = F.when(~F.col("_alone"), F.struct("_day", (F.col("_all") - F.col("_n")).alias("_all")))
    judged = (
        placed.withColumn("_gap", gap.cast("int"))
        .withColumn("_run", F.sum("_gap").over(by_value))
        .withColumn("_set", F.sum(F.col("_alone").cast("int")).over(run.orderBy("_seq")))
        .withColumn("_nth", F.row_number().over(Window.partitionBy(*pair, "_run", "_set").orderBy("_seq")))
        .withColumn("_open", F.col("_nth") % 2 == 1)
        .withColumn("_known", F.coalesce(F.lag("_open").over(run.orderBy("_seq")), F.lit(False)))
        .withColumn(
            "_end",
            F.coalesce(
                F.last(turn, ignorenulls=True).over(later.rowsBetween(Window.unboundedPreceding, -1)),
                F.first("_next").over(later),
            ),
        )
    )
    return judged.filter((F.col("_batch") == 0) | ~F.col("_known")).select(
        *pair, "_batch", *steps, F.col("_end._day").alias("_ended"), F.col("_end._all").alias("_copies")
    )


def replay_open(
    open_versions: DataFrame,
    incoming: DataFrame,
    loaded_at: str,
    ids: Sequence[str] = MERGE_KEYS,
    tracked: str = "price",
    copies: str = ONCE,
    steps: Sequence[str] = ("valid_from",),
) -> DataFrame:
    """What ``merge_open`` gives after one batch for each value of ``steps``, in that order.

    Each batch has one ``valid_from``. The number of exchanges does not depend on
    the number of batches: the wide rows move once, to meet what was decided
    about their (id, value, step).
    """
    ids, steps = list(ids), list(steps)
    pair, columns = [*ids, tracked], lean(open_versions).columns
    # ids that no batch brings stay as they are; nothing is decided about them
    brought = incoming.dropna(subset=pair).select(*ids).distinct()
    open_pairs = open_versions.select(*pair).dropna().join(brought, ids, "left_semi").distinct()
    decided = _lifetimes(open_pairs, incoming, ids, tracked, steps).withColumn("_found", F.lit(True))
    keys = [*pair, "_batch", *steps]
    decided = decided.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_ended", "_copies", "_found")
    # valid_from may be a step: open versions take part as step NULL of batch 0
    old = open_versions.withColumns({"_batch": F.lit(0), **{f"_key_{s}": F.lit(None) for s in steps}})
    new = incoming.withColumns({"_batch": F.lit(1), **{f"_key_{s}": F.col(s) for s in steps}})
    own = [*columns, "_batch", *[f"_key_{s}" for s in steps]]
    rows = new.select(*own).unionByName(old.select(*own))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"_key_{k}" if k in steps else k).eqNullSafe(F.col(f"_of_{k}"))
    unknown = F.lit(False)
    for k in pair:
        unknown = unknown | F.col(k).isNull()
    met = rows.join(decided, same, "left").filter(F.col("_found") | (F.col("_batch") == 0) | unknown)
    return restored(end_versions(met, columns, F.col("_ended"), loaded_at, copies), open_versions.columns)


def replay(
    gold: DataFrame,
    incoming: DataFrame,
    loaded_at: str,
    ids: Sequence[str] = MERGE_KEYS,
    tracked: str = "price",
    copies: str = ONCE,
    steps: Sequence[str] = ("valid_from",),
) -> DataFrame:
    """Full history after many batches in one pass; closed versions bypass every join."""
    return closed_rows(gold).unionByName(
        replay_open(current_rows(gold), incoming, loaded_at, ids, tracked, copies, steps)
    )


# ------------------------------------------------------------ late arrivals


def split_late(
    incoming: DataFrame, gold: DataFrame, ids: Sequence[str] = MERGE_KEYS
) -> tuple[DataFrame, DataFrame]:
    """Batch rows older than the newest version of their id, and all the others.

    Rows without a city are never late: a rebuild follows the bulk rules, which
    have no place for them, so they take the merge path and nothing is lost.
    """
    ids = list(ids)
    newest = gold.dropna(subset=ids).groupBy(*ids).agg(F.max("valid_from").alias("_newest"))
    dated = incoming.join(newest, ids, "left")
    is_late = F.coalesce(
        (F.col("_newest") > F.col("valid_from")) & (F.col("city") != ""), F.lit(False)
    )
    return (
        dated.filter(is_late).select(*incoming.columns),
        dated.filter(~is_late).select(*incoming.columns),
    )


def rebuild_late(
    gold: DataFrame,
    silver: DataFrame,
    late: DataFrame,
    loaded_at: str,
    ids: Sequence[str] = MERGE_KEYS,
    keys: Sequence[str] = BULK_KEYS,
    date: str = "snapshot_date",
    tie_break: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Recompute the history of late ids from ``silver``; keep all other rows.

    Gold rows without a city stay even for a late id, since the bulk rules that
    rebuild the rest do not produce them.
    """
    affected = late.select(*ids).distinct()
    rows = silver if "table_name" not in ids else only_traded(silver)
    order = row_tie_break(silver) if tie_break is None else tie_break
    touched = lean(rows).join(affected, list(ids), "left_semi")
    rebuilt = bulk_history(restored(touched, rows.columns), loaded_at, keys, date, order)
    no_city = F.col("city").isNull() | (F.col("city") == "")
    kept = restored(lean(gold.filter(~no_city)).join(affected, list(ids), "left_anti"), gold.columns)
    return (
        gold.filter(no_city)
        .unionByName(kept)
        .unionByName(rebuilt.select(*gold.columns))
    )


# ------------------------------------------------------------ reads


def as_of(gold: DataFrame, day: Column) -> DataFrame:
    """Versions valid on a day: begun by then and not yet ended."""
    day = day.cast("date")
    return gold.filter(
        (F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") > day))
    )


def as_of_join(
    asked: DataFrame, versions: DataFrame, keys: Sequence[str], day: str, columns: Sequence[str]
) -> DataFrame:
    """``asked`` with the version of its key that was valid on its day: columns, valid_from, valid_to.

    Versions and the distinct days of each key are put in one order, and a window
    carries the last version on: no range join, and at most one row for each key
    and day in the window, however often a key is asked for. What was found meets
    the asked rows in an equi-join that Spark can split. Of versions that begin on
    one day the largest counts. NULL keys and days, and days without a valid
    version, get NULLs.
    """
    keys, shown = list(keys), [*columns, "valid_from", "valid_to"]
    begun = versions.dropna(subset=[*keys, "valid_from"]).groupBy(*keys, F.col("valid_from").alias("_day")).agg(
        F.max(F.struct("valid_from", "valid_to", *columns)).alias("_version")
    )
    days = asked.select(*keys, F.col(day).cast("date").alias("_day")).dropna().distinct()
    order = Window.partitionBy(*keys).orderBy("_day", "_asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        begun.withColumn("_asked", F.lit(0))
        .unionByName(days.withColumn("_asked", F.lit(1)), allowMissingColumns=True)
        .withColumn("_version", F.last("_version", ignorenulls=True).over(order))
        .filter("_asked = 1 AND (_version.valid_to IS NULL OR _version.valid_to > _day)")
        .select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_day", "_version")
    )
    same = F.col(day).cast("date") == F.col("_day")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_of_{k}"))
    return asked.join(found, same, "left").select(*asked.columns, *[F.col(f"_version.{c}").alias(c) for c in shown])
