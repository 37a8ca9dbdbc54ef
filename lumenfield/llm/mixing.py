"""Mixing sources to target weights by capped water-filling; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenfield.llm.common import n_words, stash

#: Slices of a source's seeded order. Running totals are made over slices, then inside each, so a hot source is no single task.
SLICES = 4096


def targets(sources: DataFrame, weight: Column, max_epochs: float = 3.0, total: Column | None = None) -> DataFrame:
    """``sources`` (a row each, with ``source_size``) with the column ``target``.

    Targets are shares of ``total`` (the sum of all sizes if not given) by ``weight``. A target stops at ``max_epochs``
    times its source's size, and the excess goes to the others by weight until none is above: the level is the
    first, in the order of size per weight, at which a source needs no clamp. Sources of no size get 0. If the caps
    don't reach the total, every source gets its cap.
    """
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy("__ratio", "source").rowsBetween(Window.unboundedPreceding, -1)
    cap = F.col("source_size") * F.lit(float(max_epochs))
    out = sources.withColumn("__weight", F.when(F.col("source_size") > 0, weight.cast("double")).otherwise(0.0))
    out = out.withColumn("__ratio", F.when(F.col("__weight") > 0, cap / F.col("__weight")))
    out = out.withColumn("__total", total if total is not None else F.sum("source_size").over(every))
    left = F.sum("__weight").over(every) - F.coalesce(F.sum("__weight").over(by_ratio), F.lit(0.0))
    clamped = F.coalesce(F.sum(F.when(F.col("__ratio").isNotNull(), cap)).over(by_ratio), F.lit(0.0))
    out = out.withColumn("__level", F.try_divide(F.col("__total") - clamped, left))
    fits = F.col("__ratio").isNotNull() & (F.col("__level") <= F.col("__ratio"))
    out = out.withColumn("__level", F.min_by(F.when(fits, F.col("__level")), F.when(fits, F.col("__ratio"))).over(every))
    share = F.coalesce(F.least(F.col("__weight") * F.col("__level"), cap), cap)
    out = out.withColumn("target", F.when(F.col("__weight") > 0, share).otherwise(0.0))
    return out.drop("__weight", "__ratio", "__total", "__level")


def source_table(sized: DataFrame, weights: Sequence[float]) -> DataFrame:
    """One row a source: its size, and its weight by the order of code points, null last."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    table = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return table.withColumn("weight", F.element_at(F.lit(list(weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))


def ordered_maps(value: Column, kind: T.DataType) -> Column:
    """A value with its maps, wherever they are nested, as their entries by key."""
    if isinstance(kind, T.MapType):
        entry = lambda e: F.struct(ordered_maps(e["key"], kind.keyType).alias("key"), ordered_maps(e["value"], kind.valueType).alias("value"))
        return F.sort_array(F.transform(F.map_entries(value), lambda e: F.struct(F.to_json(F.struct(entry(e)["key"])).alias("by"), entry(e).alias("entry"))))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: ordered_maps(x, kind.elementType))
    if isinstance(kind, T.StructType) and kind.fields:
        return F.when(value.isNotNull(), F.struct(*(ordered_maps(value[f.name], f.dataType).alias(f.name) for f in kind.fields)))
    return F.to_json(value) if isinstance(kind, T.VariantType) else value


def comparable(name: str, kind: T.DataType) -> Column:
    """A column as something whose hash tells different values apart: nested ones as JSON with their nulls, since a hash passes over nulls and has none for maps."""
    value = F.col(f"`{name}`")
    if not isinstance(kind, (T.MapType, T.ArrayType, T.StructType, T.VariantType)):
        return value
    return F.to_json(F.struct(ordered_maps(value, kind).alias("v")), {"ignoreNullFields": "false"})


def row_keys(docs: DataFrame, seed: int) -> dict[str, Column]:
    """``row``: a hash of id and text, which the seeded order goes by; ``full``: one of all columns, and of which of them are null, which only equal rows share."""
    fields = docs.schema.fields
    nulls = F.concat(*(F.col(f"`{f.name}`").isNull().cast("int").cast("string") for f in fields))
    return {"row": F.xxhash64(F.lit(seed), F.col("doc_id"), F.coalesce("text", F.lit(""))), "full": F.xxhash64(nulls, *(comparable(f.name, f.dataType) for f in fields))}


def mix_items(docs: DataFrame, weights: Sequence[float], max_epochs: float, seed: int, rounds: int) -> DataFrame:
    """``(row, full, doc_id, source, size, equal, source_size, target, whole, extra)`` for each group of equal rows of ``docs``.

    ``equal`` rows are taken ``whole`` times each, and ``extra`` of them once more.
    """
    keys = row_keys(docs, seed)
    sized = docs.select("doc_id", "source", n_words("text").alias("size"), keys["row"].alias("row"), keys["full"].alias("full"))
    sized = stash(sized.groupBy("row", "full", "doc_id", "source", "size").agg(F.count("*").alias("equal")), "sizes")
    table = sized.withColumn("size", F.col("size") * F.col("equal"))
    sources = stash(targets(source_table(table, weights), F.col("weight"), max_epochs), "targets")

    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    # floating-point noise under a whole number of repetitions must not become a fraction
    whole = F.floor(rate + 1e-9)
    need = F.greatest(F.col("target") - whole * F.col("source_size"), F.lit(0.0))
    plan = sources.select(F.col("source").alias("of"), "source_size", "target", whole.cast("int").alias("whole"), need.alias("need"))
    items = sized.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    items = items.withColumns({"slice": F.pmod(F.col("row"), F.lit(SLICES)).cast("int"), "extra": F.lit(0).cast("long")})
    for k in range(rounds):
        items = stash(fill(missing_of(items)), f"round-{k}")
    return top_up(missing_of(items))


def mix(docs: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0), max_epochs: float = 3.0, seed: int = 5, rounds: int = 3) -> DataFrame:
    """``(row, doc_id, source, size, source_size, target, copies)`` for each row of ``docs``.

    Each source is repeated as a whole ``floor(target / source_size)`` times. Its fractional repetition takes documents in a
    seeded order while they fit. Each further round does so among those left that fit in what is missing; then the
    one whose size is nearest to what is still missing is taken, if that helps. ``copies`` counts all and never is
    above ``ceil(max_epochs)``. ``row`` is a hash of id and text. Equal rows are taken one by one like others. Null and empty texts have size 0 and
    are taken with the whole repetitions only. An empty table gives an empty result. Other columns only tell equal rows from others.
    """
    items = mix_items(docs, weights, max_epochs, seed, rounds)
    each = items.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("equal"))))
    return each.select("row", "doc_id", "source", "size", "source_size", "target", (F.col("whole") + (F.col("i") <= F.col("extra")).cast("int")).alias("copies"))


def missing_of(items: DataFrame) -> DataFrame:
    """``items`` with ``missing``: what their source's fractional repetition still lacks."""
    had = items.groupBy(F.col("source").alias("of")).agg(F.sum(F.col("extra") * F.col("size")).alias("had"))
    joined = items.join(stash(had, "had"), F.col("source").eqNullSafe(F.col("of")))
    return joined.withColumn("missing", F.col("need") - F.col("had")).drop("of", "had")


def fill(items: DataFrame) -> DataFrame:
    """Each source takes rows that fit in what is missing, in the seeded order, up to the first that no longer does."""
    fits = (F.col("size") > 0) & (F.col("size") <= F.col("missing"))
    items = items.withColumn("part", F.when(fits, F.col("size") * (F.col("equal") - F.col("extra"))).otherwise(0))
    slices = items.groupBy(F.col("source").alias("of"), F.col("slice").alias("at")).agg(F.sum("part").alias("slice_size"))
    before = Window.partitionBy("of").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("start", F.coalesce(F.sum("slice_size").over(before), F.lit(0)))
    inside = Window.partitionBy("source", "slice").orderBy("row", "doc_id", "full").rowsBetween(Window.unboundedPreceding, 0)
    out = items.withColumn("end", F.sum("part").over(inside))
    out = out.join(slices, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("at")))
    room = F.floor((F.col("missing") - (F.col("start") + F.col("end") - F.col("part"))) / F.col("size"))
    taken = F.when(F.col("part") > 0, F.greatest(F.least(F.col("equal") - F.col("extra"), room), F.lit(0))).otherwise(0)
    return out.withColumn("extra", (F.col("extra") + taken).cast("long")).select(*(c for c in items.columns if c not in ("part", "missing")))


def top_up(items: DataFrame) -> DataFrame:
    """Each source also takes the row, among those left, whose size is nearest to what is missing, if that helps."""
    off = F.abs(F.col("missing") - F.col("size"))
    usable = (F.col("extra") < F.col("equal")) & (F.col("size") > 0) & (off < F.col("missing"))
    best = items.filter(usable).groupBy("source").agg(F.min(F.struct(off.alias("off"), "row", "doc_id", "full")).alias("best"))
    best = stash(best.select(F.col("source").alias("of"), F.col("best.row").alias("row_of"), F.col("best.doc_id").alias("id_of"), F.col("best.full").alias("full_of")), "top-up")
    out = items.join(best, F.col("source").eqNullSafe(F.col("of")), "left")
    one = (F.col("row") == F.col("row_of")) & (F.col("full") == F.col("full_of")) & F.col("doc_id").eqNullSafe(F.col("id_of"))
    return out.withColumn("extra", F.col("extra") + F.coalesce(one, F.lit(False)).cast("long")).drop("of", "row_of", "id_of", "full_of")


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0), max_epochs: float = 3.0, seed: int = 5) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Of equal rows one stands for all."""
    items = mix_items(docs, weights, max_epochs, seed, 3)
    copies = stash(
        items.select(F.col("full").alias("__key"), F.col("doc_id").alias("__id"), F.col("equal").alias("__equal"), (F.col("whole") * F.col("equal") + F.col("extra")).alias("__copies")).filter("__copies > 0"), "copies"
    )
    keyed = docs.withColumn("__full", row_keys(docs, seed)["full"])
    same = (F.col("__full") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    # shuffled at every size, as what is taken grows with the documents
    joined = keyed.join(copies.filter("__equal = 1").hint("merge"), same)
    several = copies.filter("__equal > 1")
    if not several.isEmpty():
        joined = joined.unionByName(keyed.join(several, same, "left_semi").dropDuplicates(["__full", "doc_id"]).join(several, same))
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies").cast("long")))).select(docs.columns)
