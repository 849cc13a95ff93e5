"""Seeded order and cross-validation folds.

The shuffle is the order of ``order_key``, a digest of seed and text. A fold of a contiguous split
is a range of that order, so it is enough to know the keys at which the folds 2, 3, ... begin:
``n_folds - 1`` keys per corpus, or per corpus and class when stratified. They are found by counting
keys per two-byte prefix, which tells the bucket and the place inside it of every limit, and by ranking
the keys of those few buckets only. A row then gets its fold by comparing its key with the limits: no
global sort, no rank of all rows, and no shuffle of texts.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldloom.joins import fits_broadcast, lookup_join, null_safe_join
from foldloom.operators.dedup import dedup_first

N_FOLDS = 5
BUCKET_BYTES = 2
CLASS_PART_DIGITS = 2
CLASS_PARTS = 16**CLASS_PART_DIGITS
# Open label sets: finer parts, which hold whole classes of up to CLASS_ROWS rows.
PLACE_PART_DIGITS = 3
CLASS_CELL_DIGITS = 4
CLASS_ROWS = 100_000


def _bucket() -> Column:
    # Never null, so that a join on it adds no null filter and both uses of the keys stay one shuffle.
    return F.coalesce(F.substring("order_key", 1, BUCKET_BYTES), F.lit(b""))


def seeded_position(rows: DataFrame, within: Sequence[str] = (), fits: bool | None = None) -> DataFrame:
    """The dense 0-based place of every row in the seeded shuffle, as ``position``.

    ``rows`` must be distinct by ``order_key``. Places are counted inside a bucket and shifted by
    the rows of the buckets before it, so that no task holds more than one bucket.
    """
    group = list(within)
    before = Window.partitionBy(*group).orderBy("_bucket")
    starts = (
        rows.groupBy(*group, _bucket().alias("_bucket"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_start", F.sum("_n").over(before) - F.col("_n"))
        .drop("_n")
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy("order_key")
    ranked = rows.withColumn("_bucket", _bucket()).withColumn("_rank", F.row_number().over(inside) - 1)
    placed = lookup_join(ranked, starts, [*group, "_bucket"], fits=fits)
    return placed.withColumn("position", F.col("_start") + F.col("_rank")).drop("_bucket", "_rank", "_start")


def _rows_of_first_folds(position: Column, folds: int, n_folds: int) -> Column:
    """How many of the places 0 .. position-1, dealt out in turn, the first ``folds`` folds get."""
    return F.floor(position / n_folds) * folds + F.least(position % n_folds, F.lit(folds))


def class_key(stratum: Column) -> Column:
    """What classes are ordered by: a digest of the label, so that any prefix of it deals classes out evenly."""
    return F.md5(F.coalesce(F.concat(F.lit("="), stratum.cast("string")), F.lit("")).cast("binary"))


def _rows_of_earlier_classes(sizes: DataFrame, outer: Sequence[str], stratum: str) -> DataFrame:
    """``_offset`` of every class: the rows of the classes before it in its group.

    Classes are summed inside the parts of the digest's order and shifted by the parts before, of which a group has
    ``CLASS_PARTS`` at most, so that no task holds all classes of an open label set.
    """
    key = class_key(F.col(stratum))
    keyed = sizes.withColumn("_key", key).withColumn("_part", F.substring("_key", 1, CLASS_PART_DIGITS))
    inside = Window.partitionBy(*outer, "_part").orderBy("_key")
    summed = keyed.withColumn("_within", F.sum("_n").over(inside) - F.col("_n"))
    parts = keyed.groupBy(*outer, "_part").agg(F.sum("_n").alias("_n"))
    starts = _rows_of_earlier_parts(parts, outer)
    placed = null_safe_join(summed, starts, [*outer, "_part"])
    return placed.select(*outer, stratum, (F.col("_start") + F.col("_within")).alias("_offset"))


def _rows_of_earlier_parts(parts: DataFrame, outer: Sequence[str]) -> DataFrame:
    """``_start`` of every part: the rows ``_n`` of the parts before it in its group, of which there are few."""
    lists = parts.groupBy(*outer).agg(F.collect_list(F.struct("_part", "_n")).alias("_parts"))
    if outer:
        listed = null_safe_join(parts, lists, outer)
    else:
        listed = parts.withColumn("_parts", lists.select("_parts").scalar())
    earlier = F.filter("_parts", lambda p: p["_part"] < F.col("_part"))
    total = F.aggregate(earlier, F.lit(0).cast("bigint"), lambda n, p: n + p["_n"])
    return listed.select(*outer, "_part", total.alias("_start"))


def fold_limits(
    keys: DataFrame,
    within: Sequence[str] = (),
    stratum: str | None = None,
    n_folds: int = N_FOLDS,
    fits: bool | None = None,
    offsets: DataFrame | None = None,
) -> DataFrame:
    """The keys ``limit_1 ..`` at which the folds 2 .. n_folds begin, per group and stratum.

    Fold sizes come from dealing the places of the whole group out in turn, with the strata one after
    another in the order of a digest of the label. Inside a stratum the counts differ by at most one, and so do the totals.
    Without strata this is the even contiguous split whose first ``n mod n_folds`` folds have one more.
    A limit is null when no row lies behind it. ``offsets`` tells the rows of the strata before each one if ``keys`` are not those of all strata.
    """
    outer = list(within)
    group = outer + ([stratum] if stratum else [])
    counts = keys.groupBy(*group, _bucket().alias("_bucket")).agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*group)
    runs = counts.withColumn("_end", F.sum("_n").over(whole.orderBy("_bucket"))).withColumn(
        "_size", F.sum("_n").over(whole)
    )
    if stratum:
        if offsets is None:
            sizes = counts.groupBy(*group).agg(F.sum("_n").alias("_n"))
            offsets = _rows_of_earlier_classes(sizes, outer, stratum)
        runs = null_safe_join(runs, offsets, group)
    else:
        runs = runs.withColumn("_offset", F.lit(0).cast("bigint"))

    first, last = F.col("_offset"), F.col("_offset") + F.col("_size")
    cuts = [_rows_of_first_folds(last, i, n_folds) - _rows_of_first_folds(first, i, n_folds) for i in range(1, n_folds)]
    wanted = F.array(*[F.struct(F.lit(i + 1).alias("no"), cut.alias("at")) for i, cut in enumerate(cuts)])
    targets = (
        runs.withColumn("_cut", F.explode(wanted))
        .where((F.col("_cut.at") >= F.col("_end") - F.col("_n")) & (F.col("_cut.at") < F.col("_end")))
        .select(
            *group,
            "_bucket",
            F.col("_cut.no").alias("_no"),
            (F.col("_cut.at") - F.col("_end") + F.col("_n")).alias("_skip"),
        )
    )
    if fits is None:
        fits = fits_broadcast(keys.select(*group).distinct()) if group else True
    near = null_safe_join(
        keys.withColumn("_bucket", _bucket()), F.broadcast(targets) if fits else targets, [*group, "_bucket"]
    )
    place = F.row_number().over(Window.partitionBy(*group, "_bucket", "_no").orderBy("order_key")) - 1
    found = near.withColumn("_place", place).where("_place = _skip")
    return found.groupBy(*group).agg(
        *[F.max(F.when(F.col("_no") == i, F.col("order_key"))).alias(f"limit_{i}") for i in range(1, n_folds)]
    )


def apply_limits(
    rows: DataFrame,
    limits: DataFrame,
    on: Sequence[str] = (),
    n_folds: int = N_FOLDS,
    fits: bool | None = None,
) -> DataFrame:
    """Add ``fold`` 1 .. n_folds by comparing the key of a row with the limits of its group."""
    names = [f"limit_{i}" for i in range(1, n_folds)]
    if on:
        joined = lookup_join(rows, limits, on, "left", fits).withColumn("_limits", F.struct(*names)).drop(*names)
    else:
        # One group has one row of limits, which is a scalar.
        joined = rows.withColumn("_limits", limits.select(F.struct(*names)).scalar())
    behind = [F.when(F.col("order_key") >= F.col(f"_limits.{name}"), 1).otherwise(0) for name in names]
    return joined.withColumn("fold", sum(behind, F.lit(1)).cast("int")).drop("_limits")


def contiguous_folds(
    rows: DataFrame, within: Sequence[str] = (), n_folds: int = N_FOLDS, fits: bool | None = None
) -> DataFrame:
    """Folds of a table whose ``order_key`` is distinct within the group."""
    keys = rows.select(*within, "order_key")
    return apply_limits(rows, fold_limits(keys, within, None, n_folds, fits), within, n_folds, fits)


def _large_classes(labels: DataFrame, outer: Sequence[str], stratum: str) -> DataFrame:
    """The classes of more than ``CLASS_ROWS`` rows, found by counting the cells of the digest's order first, so that an open label set
    is not shuffled for it."""
    celled = labels.withColumn("_cell", F.substring(class_key(F.col(stratum)), 1, CLASS_CELL_DIGITS))
    cells = celled.groupBy("_cell").agg(F.count("*").alias("_rows")).where(F.col("_rows") > CLASS_ROWS).select("_cell")
    near = lookup_join(celled, cells, ["_cell"], fits=True)
    return near.groupBy(*outer, stratum).agg(F.count("*").alias("_n")).where(F.col("_n") > CLASS_ROWS).select(*outer, stratum)


def _class_places(rows: DataFrame, outer: Sequence[str], stratum: str, whole: DataFrame | None) -> DataFrame:
    """Rows with ``_at``, their place in their class, ``_size`` of the class and ``_offset``, the rows of the classes before it.

    Rows are shuffled once, by the parts of the order of classes, and sorted once. ``whole`` has a row with the size ``_rows`` for each class
    that is counted and not placed; these rows come out as well, marked by ``_whole``.
    """
    marked = rows.withColumns({"_rows": F.lit(1).cast("bigint"), "_whole": F.lit(False)})
    if whole is not None:
        marked = marked.unionByName(whole.withColumn("_whole", F.lit(True)), allowMissingColumns=True)
    digest = class_key(F.col(stratum))
    part = F.conv(F.substring(digest, 1, PLACE_PART_DIGITS), 16, 10).cast("int")
    keyed = marked.withColumns({"_key": F.unhex(digest), "_part": part})
    starts = _rows_of_earlier_parts(keyed.groupBy(*outer, "_part").agg(F.sum("_rows").alias("_n")), outer)
    in_part = Window.partitionBy(*outer, "_part").orderBy("_key", "order_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_class = Window.partitionBy(*outer, "_part", "_key")
    placed = (
        keyed.withColumn("_before", F.sum("_rows").over(in_part) - F.col("_rows"))
        .withColumn("_at", F.row_number().over(in_class.orderBy("order_key")) - 1)
        .withColumn("_size", F.sum("_rows").over(in_class))
    )
    begun = lookup_join(placed, starts, [*outer, "_part"], fits=None if outer else True)
    return begun.withColumn("_offset", F.col("_start") + F.col("_before") - F.col("_at")).drop("_start", "_before", "_key", "_part")


def _open_strata_folds(rows: DataFrame, labels: DataFrame, outer: Sequence[str], stratum: str, n_folds: int) -> DataFrame:
    """``stratified_folds`` for classes without a bound on their number, which limits by class would outgrow.

    Classes of up to ``CLASS_ROWS`` rows are ranked whole, many to a part. Larger ones, of which there are few, get limits. ``labels`` are
    those of ``rows`` or more, in which the larger ones are looked for.
    """
    group, names = [*outer, stratum], rows.columns
    large, small, whole, rest = _large_classes(labels, outer, stratum), rows, None, None
    if not large.isEmpty():
        fits = fits_broadcast(large)
        split = lookup_join(rows, large.withColumn("_large", F.lit(True)), group, "left", fits)
        small, rest = split.where("_large IS NULL").select(*names), split.where("_large").select(*names)
        whole = rest.groupBy(*group).agg(F.count("*").alias("_rows"))
    places = _class_places(small, outer, stratum, whole)
    first, last = F.col("_offset"), F.col("_offset") + F.col("_size")
    cuts = [_rows_of_first_folds(last, i, n_folds) - _rows_of_first_folds(first, i, n_folds) for i in range(1, n_folds)]
    fold = sum([F.when(F.col("_at") >= cut, 1).otherwise(0) for cut in cuts], F.lit(1)).cast("int")
    folded = places.where("NOT _whole").select(*names, fold.alias("fold"))
    if rest is None:
        return folded
    limits = fold_limits(rest.select(*group, "order_key"), outer, stratum, n_folds, fits, places.where("_whole").select(*group, "_offset"))
    return folded.unionByName(apply_limits(rest, limits, group, n_folds, fits))


def stratified_folds(
    rows: DataFrame,
    within: Sequence[str] = (),
    stratum: str = "label",
    n_folds: int = N_FOLDS,
    fits: bool | None = None,
    labels: DataFrame | None = None,
) -> DataFrame:
    """As ``contiguous_folds``, with every class spread over the folds by itself.

    ``labels`` may be a cheaper table with the groups and labels of ``rows``, or of more rows, to look for large classes in.
    """
    group = [*within, stratum]
    labels = rows if labels is None else labels
    if fits is None:
        fits = fits_broadcast(labels.select(*group).distinct())
    if not fits:
        return _open_strata_folds(rows, labels.select(*group), within, stratum, n_folds)
    keys = rows.select(*group, "order_key")
    return apply_limits(rows, fold_limits(keys, within, stratum, n_folds, fits), group, n_folds, fits)


def dedup_and_fold(
    rows: DataFrame,
    rule: str = "contiguous",
    within: Sequence[str] = (),
    row_id: str = "row_id",
    n_folds: int = N_FOLDS,
    fits: bool | None = None,
) -> DataFrame:
    """Dedup and folds in one: texts are shuffled once, by the dedup.

    The limits of contiguous folds depend on the set of keys only, which is the same before and
    after dedup, so they come from a distinct of 32-byte keys. Stratified ones need the label of the survivor.
    ``fits`` tells whether the groups (and classes) are few by construction; else they are counted.
    """
    group = [*within, "label"] if rule == "stratified" else list(within)
    if fits is None:
        fits = fits_broadcast(rows.select(*group).distinct()) if group else True
    survivors = dedup_first(rows, row_id, within)
    if rule == "stratified":
        return stratified_folds(survivors, within, "label", n_folds, fits, rows.select(*group))
    keys = rows.select(*within, "order_key").distinct()
    return apply_limits(survivors, fold_limits(keys, within, None, n_folds, fits), within, n_folds, fits)


def has_stratum_for_all_folds(rows: DataFrame, stratum: str = "label", n_folds: int = N_FOLDS) -> bool:
    """Whether any class can be spread over all folds. Reads one number."""
    sizes = rows.groupBy(stratum).agg(F.count("*").alias("n"))
    return (sizes.agg(F.max("n")).first()[0] or 0) >= n_folds


def small_strata(rows: DataFrame, within: Sequence[str] = (), stratum: str = "label", n_folds: int = N_FOLDS) -> DataFrame:
    """Classes with fewer rows than folds, as WARN; FAIL when that holds for every class of the group."""
    sizes = rows.groupBy(*within, stratum).agg(F.count("*").alias("n"))
    largest = F.max("n").over(Window.partitionBy(*within))
    return (
        sizes.withColumn("_largest", largest)
        .where(F.col("n") < n_folds)
        .select(
            *within, stratum, "n", F.when(F.col("_largest") < n_folds, "FAIL").otherwise("WARN").alias("severity")
        )
    )
