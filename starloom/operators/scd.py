"""Slowly changing dimensions.

* ``scd1_upsert``: overwrite in place (INSERT ... ON CONFLICT DO UPDATE).
* ``scd2_detect`` / ``scd2_expire`` / ``scd2_insert`` / ``scd2_apply``: versioned history with
  change detection by a row hash;
* ``scd2_splice``: a batch of any date, also one before versions that are already there.

Each operator is a pure function ``(current table, source batch) -> new table``. The caller
writes the result to a new location and then switches to it; the path being read is never
overwritten. Keys and hashes meet in one keyed ``full_outer`` join; versions are closed and opened
by joins on the natural key with its result; new surrogate keys come from
``ranking.assign_surrogate_keys``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.contracts import SENTINEL_EXPIRY
from starloom.operators.ranking import assign_surrogate_keys, pin

NEW = "new"
CHANGED = "changed"
UNCHANGED = "unchanged"
ABSENT = "absent"

SINGLE_PASS = "single_pass"
DEFERRED = "deferred"


def _lit_date(d: date | str | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(d).cast("date")


def _max_key(dim: DataFrame, key: str) -> Column:
    """Largest surrogate key in use (0 for an empty table), as a scalar subquery."""
    return dim.agg(F.coalesce(F.max(key), F.lit(0)).cast("long").alias("m")).scalar()


def check_unique_batch(source: DataFrame, key: Sequence[str]) -> None:
    """A batch must not carry a natural key twice (the upsert would be ambiguous)."""
    dup = source.groupBy(*key).count().where("count > 1").limit(1).collect()
    if dup:
        raise ValueError(f"duplicate natural key in source batch: {dup[0].asDict()}")


def scd1_upsert(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    surrogate: str,
    update_cols: Sequence[str],
    validate: bool = True,
) -> DataFrame:
    """Type 1 merge.

    * key in both: the ``update_cols`` take the source value (a NULL overwrites too), every
      other column keeps the target value, the surrogate key is kept;
    * key only in the source: inserted with a new surrogate key;
    * key only in the target: kept unchanged.
    """
    key = list(key)
    if validate:
        check_unique_batch(source, key)
    cols = [c for c in target.columns if c != surrogate and c not in key]
    t = target.select(*key, surrogate, *[F.col(c).alias(f"t__{c}") for c in cols],
                      F.lit(True).alias("t__present"))
    s = source.select(*key, *[F.col(c).alias(f"s__{c}") for c in cols if c in source.columns],
                      F.lit(True).alias("s__present"))
    j = t.join(s, key, "full_outer")
    in_src = F.col("s__present").isNotNull()
    in_tgt = F.col("t__present").isNotNull()

    def value(c: str) -> Column:
        src = F.col(f"s__{c}") if c in source.columns else F.lit(None)
        if c in update_cols:
            return F.when(in_src, src).otherwise(F.col(f"t__{c}")).alias(c)
        return F.when(in_tgt, F.col(f"t__{c}")).otherwise(src).alias(c)

    merged = j.select(*key, F.col(surrogate), *[value(c) for c in cols], in_tgt.alias("__old"))
    key_type = target.schema[surrogate].dataType.simpleString()
    kept = merged.where("__old").drop("__old")
    fresh = assign_surrogate_keys(
        merged.where(~F.col("__old")).drop("__old", surrogate),
        key, surrogate, start_after=_max_key(target, surrogate), key_type=key_type,
    )
    return kept.unionByName(fresh).select(*target.columns)


def scd2_detect(
    current: DataFrame, source: DataFrame, key: Sequence[str], hash_col: str = "row_hash"
) -> DataFrame:
    """Classify each natural key of (current versions, source batch).

    Output: ``key`` columns + ``status`` in {new, changed, unchanged, absent}. A key is
    ``changed`` only when both hashes are present and differ (a NULL hash never differs,
    as ``<>`` on NULL is not true).
    """
    key = list(key)
    c = current.select(*key, F.col(hash_col).alias("__cur_hash"), F.lit(True).alias("__cur"))
    s = source.select(*key, F.col(hash_col).alias("__src_hash"), F.lit(True).alias("__src"))
    j = c.join(s, key, "full_outer")
    status = (
        F.when(F.col("__cur").isNull(), F.lit(NEW))
        .when(F.col("__src").isNull(), F.lit(ABSENT))
        .when(F.col("__cur_hash") != F.col("__src_hash"), F.lit(CHANGED))
        .otherwise(F.lit(UNCHANGED))
    )
    return j.select(*key, status.alias("status"))


def scd2_expire(
    current: DataFrame, status: DataFrame, key: Sequence[str], as_of: date | str | Column
) -> DataFrame:
    """Close the current versions of changed keys: expiry = as_of - 1 day, not current.

    Versions of unchanged keys and of keys missing from the batch stay current.
    """
    key = list(key)
    changed = F.col("status") == F.lit(CHANGED)
    j = current.join(status.select(*key, "status"), key, "left")
    cols = []
    for c in current.columns:
        if c == "expiry_date":
            cols.append(F.when(changed, F.date_sub(_lit_date(as_of), 1))
                        .otherwise(F.col(c)).alias(c))
        elif c == "is_current":
            cols.append(F.when(changed, F.lit(False)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def scd2_insert(
    source: DataFrame,
    status: DataFrame,
    key: Sequence[str],
    surrogate: str,
    as_of: date | str | Column,
    start_after: int | Column,
    statuses: Sequence[str] = (NEW, CHANGED),
    key_type: str = "int",
) -> DataFrame:
    """Opening versions for the keys whose status is in ``statuses``: effective = as_of,
    expiry = 9999-12-31, current = true, fresh surrogate keys."""
    key = list(key)
    chosen = status.where(F.col("status").isin(*statuses)).select(*key)
    rows = source.join(chosen, key, "left_semi")
    rows = rows.select(
        *source.columns,
        _lit_date(as_of).alias("effective_date"),
        F.lit(SENTINEL_EXPIRY).cast("date").alias("expiry_date"),
        F.lit(True).alias("is_current"),
    )
    return assign_surrogate_keys(rows, key, surrogate, start_after=start_after, key_type=key_type)


def scd2_apply(
    dim: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    surrogate: str,
    as_of: date | str | Column,
    mode: str = SINGLE_PASS,
    hash_col: str = "row_hash",
    validate: bool = True,
    source_rows: DataFrame | None = None,
) -> DataFrame:
    """One Type 2 load of ``source`` into ``dim``.

    ``source_rows`` is a cheap table with the same rows per key as ``source`` (the staging
    table a derived source was built from by 1:1 joins): the batch-uniqueness check scans it
    instead of evaluating the derived source.

    ``mode='single_pass'`` expires a changed version and opens its successor in the same run
    (the documented intent). ``mode='deferred'`` reproduces the literal two-statement
    outcome where the insert still sees the pre-update snapshot: a changed key is only
    expired in this run, and its new version is opened by the next run.

    History rows (``is_current = false``) never enter the join.
    """
    if mode not in (SINGLE_PASS, DEFERRED):
        raise ValueError(f"unknown mode {mode!r}")
    key = list(key)
    raw = source if source_rows is None else source_rows
    if validate:
        check_unique_batch(raw, key)
    history = dim.where(~F.col("is_current"))
    current = dim.where(F.col("is_current"))
    # the derived source is evaluated once: for the status, and for the versions it opens
    source = pin(source)
    # one narrow row per key (key, status), classified once for both steps
    status = pin(scd2_detect(current, source, key, hash_col))
    closed = scd2_expire(current, status, key, as_of)
    opened = scd2_insert(
        source, status, key, surrogate, as_of, start_after=_max_key(dim, surrogate),
        statuses=(NEW, CHANGED) if mode == SINGLE_PASS else (NEW,),
        key_type=dim.schema[surrogate].dataType.simpleString(),
    )
    return history.unionByName(closed).unionByName(opened.select(*dim.columns))


def observations(source: DataFrame, key: Sequence[str], as_of: date | str | Column, hash_col: str = "row_hash") -> DataFrame:
    """What a batch shows: (key, observed_on, hash) of each of its rows, for the log that
    :func:`scd2_splice` reads. A row is some dozens of bytes."""
    return source.select(*key, _lit_date(as_of).alias("observed_on"), F.col(hash_col).alias("observed"))


def scd2_splice(
    dim: DataFrame,
    log: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    surrogate: str,
    as_of: date | str,
    hash_col: str = "row_hash",
) -> tuple[DataFrame, DataFrame]:
    """One Type 2 load of a batch of any date; returns the new dimension and the new log.

    ``log`` holds the :func:`observations` of every earlier batch. A batch later than all of them
    is an ordinary single-pass load. Otherwise the intervals of its keys are drawn anew from all
    their observations: a version begins where the hash differs from that of the observation before
    it, and ends the day before the next one begins. So the intervals depend on the batches and
    not on their order. Stored versions keep their surrogate keys: each one belongs to the
    new version that covers its first day (which may now begin earlier); other versions, such as the
    second half of one that a late change cut in two, get new keys. Attributes come from the
    batch where a version begins with it, else from the stored version of that hash.

    Keys that the batch does not hold are not touched. The same batch again changes nothing; another
    batch with the same date and a different row for a key raises, since a day holds one state.
    """
    key = list(key)
    check_unique_batch(source, key)
    source = pin(source)
    seen = observations(source, key, as_of, hash_col)
    grown = log.join(seen.select(*key, "observed_on"), [*key, "observed_on"], "left_anti").unionByName(seen)
    clash = log.alias("l").join(seen.alias("s"), [*key, "observed_on"]).where(~F.col("l.observed").eqNullSafe(F.col("s.observed")))
    if not clash.isEmpty():
        raise ValueError(f"another batch of {as_of} has different rows for the same keys")
    latest = log.agg(F.max("observed_on")).first()[0]
    if latest is None or str(latest) < str(as_of):
        return scd2_apply(dim, source, key, surrogate, as_of, hash_col=hash_col, validate=False), grown

    mine = grown.join(source.select(*key), key, "left_semi")
    by_day = Window.partitionBy(*key).orderBy("observed_on")  # one row a batch
    before = F.lag(F.struct("observed")).over(by_day)
    begins = mine.withColumn("__before", before).where(
        F.col("__before").isNull() | ~F.col("__before.observed").eqNullSafe(F.col("observed")))
    following = F.lead("observed_on").over(by_day)
    drawn = begins.select(
        *key, F.col("observed_on").alias("effective_date"), F.col("observed").alias("__hash"),
        F.coalesce(F.date_sub(following, 1), F.lit(SENTINEL_EXPIRY).cast("date")).alias("expiry_date"),
        following.isNull().alias("is_current"))
    intervals = ["effective_date", "expiry_date", "is_current"]
    attributes = [c for c in dim.columns if c not in (*key, surrogate, *intervals)]
    # a version closed before it began (a second change on one day) was never valid and stays as it is
    valid = F.col("expiry_date") >= F.col("effective_date")
    touched = dim.where(valid).join(source.select(*key), key, "left_semi")
    rest = dim.where(valid).join(source.select(*key), key, "left_anti").unionByName(dim.where(~valid))
    stored = touched.select(*key, F.col(surrogate), F.col("effective_date").alias("__day"), F.struct(*attributes).alias("__a"), F.col(hash_col).alias("__h"))
    covers = (F.col("__day") >= F.col("effective_date")) & (F.col("__day") <= F.col("expiry_date")) & F.col("__h").eqNullSafe(F.col("__hash"))
    owned = drawn.join(stored, key, "left").groupBy(*key, *intervals, "__hash").agg(
        F.min_by(surrogate, F.when(covers, F.col("__day"))).alias("__own"),
        F.min_by("__a", F.when(F.col("__h").eqNullSafe(F.col("__hash")), F.col("__day"))).alias("__a"))
    given = source.select(*key, F.struct(*attributes).alias("__given"))
    whole = pin(owned.join(given, key).select(
        *key, "__own", *intervals, F.when(F.col("effective_date") == _lit_date(as_of), F.col("__given")).otherwise(
            F.coalesce("__a", "__given")).alias("__a")))
    kept = whole.where("__own IS NOT NULL").withColumnRenamed("__own", surrogate)
    if not touched.join(kept.select(surrogate), surrogate, "left_anti").isEmpty():
        raise ValueError("the log lacks the batches of some stored versions")
    fresh = assign_surrogate_keys(
        whole.where("__own IS NULL").drop("__own"), [*key, "effective_date"], surrogate,
        start_after=_max_key(dim, surrogate), key_type=dim.schema[surrogate].dataType.simpleString())
    columns = [F.col(f"__a.{c}") if c in attributes else F.col(c) for c in dim.columns]
    return rest.select(*dim.columns).unionByName(kept.select(*columns)).unionByName(fresh.select(*columns)), grown


def scd_current(dim: DataFrame) -> DataFrame:
    """The current version of every key (``is_current = TRUE``)."""
    return dim.where(F.col("is_current"))


def overlapping_versions(dim: DataFrame, key: Sequence[str]) -> DataFrame:
    """Quality check on a Type 2 dimension, one row per offending version:

    * more than one current version of a key;
    * a version whose expiry precedes its effective date (a same-day second change);
    * a version that starts on or before the previous version of its key expired (overlap).

    The overlap test compares each version with its predecessor in a window per natural key
    (a key has one version per load, so windows are small); no pairs are formed.
    """
    key = list(key)
    multi = (
        dim.where("is_current").groupBy(*key).count().where("count > 1")
        .select(*key, F.lit("multiple current versions").alias("problem"))
    )
    inverted = dim.where(F.col("expiry_date") < F.col("effective_date")).select(
        *key, F.lit("expiry before effective date").alias("problem")
    )
    prev_expiry = F.lag("expiry_date").over(
        Window.partitionBy(*key).orderBy("effective_date", "expiry_date"))
    overlap = (
        dim.select(*key, "effective_date", prev_expiry.alias("__prev_expiry"))
        .where(F.col("__prev_expiry") >= F.col("effective_date"))
        .select(*key, F.lit("overlapping validity").alias("problem"))
    )
    return multi.unionByName(inverted).unionByName(overlap)
