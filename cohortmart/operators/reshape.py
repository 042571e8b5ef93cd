"""EAV reshaping: unpivot (wide → facts), concept catalog, CDE list, pivot (facts → wide)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmart.functions.columns import qcol

# Spark's own bound on pivot width; a catalog wider than this is refused
# before anything is collected further.
MAX_PIVOT_COLUMNS = 10000


# ---------------------------------------------------------------- unpivot --

@dataclass(frozen=True)
class UnpivotSpec:
    """One wide table to melt: id columns kept, value columns melted.

    ``id_aliases`` renames id columns so several specs union by name;
    ``value_type`` is the common type values are cast to first (Spark's
    unpivot rejects mixed types); ``drop_nulls`` drops NULL-valued cells
    (Spark keeps them, like ``UNPIVOT INCLUDE NULLS``).
    """

    source: DataFrame
    ids: Sequence[str]
    values: Sequence[str]
    id_aliases: dict[str, str] = field(default_factory=dict)
    attribute_col: str = "Attribute"
    value_col: str = "Value"
    value_type: str | None = None
    drop_nulls: bool = False


def unpivot(spec: UnpivotSpec) -> DataFrame:
    """Melt the value columns into (Attribute, Value) rows — a narrow Expand, no shuffle."""
    src = spec.source
    vals = list(spec.values)
    if spec.value_type:
        src = src.select(*[qcol(c) for c in spec.ids],
                         *[qcol(c).cast(spec.value_type).alias(c) for c in vals])
    out = src.unpivot([qcol(c) for c in spec.ids], [qcol(c) for c in vals],
                      spec.attribute_col, spec.value_col)
    if spec.drop_nulls:
        out = out.filter(F.col(spec.value_col).isNotNull())
    if spec.id_aliases:
        out = out.select(*[qcol(c).alias(spec.id_aliases.get(c, c)) for c in out.columns])
    return out


def melted_row(values: dict[str, Column], attribute_col: str, value_col: str, drop_nulls: bool = False) -> Callable[[DataFrame, Sequence[str]], DataFrame]:
    """A function (rows, kept columns) → their values (name → column of a row) as
    (attribute, value) rows.  Like :func:`unpivot`, but its rows stay ordered and
    partitioned as they were, so it can come after a join or a range shuffle of
    the wide rows."""
    def melt(rows: DataFrame, kept: Sequence[str]) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(n).alias(attribute_col), c.alias(value_col)) for n, c in values.items()])
        out = rows.select(*[qcol(c) for c in kept], F.inline(cells))
        return out.filter(qcol(value_col).isNotNull()) if drop_nulls else out
    return melt


def unpivot_many(specs: Sequence[UnpivotSpec]) -> DataFrame:
    """Several wide tables melted and appended by column name (missing ids → NULL)."""
    if not specs:
        raise ValueError("no unpivot specs")
    parts = [unpivot(s) for s in specs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


# ---------------------------------------------------------------- catalog --

def concept_catalog(facts: DataFrame) -> DataFrame:
    """One row per concept: a value type, whether types are mixed, fact count and
    the smallest provider.

    The pass over the whole fact table only counts per (concept, provider,
    value type): string keys with a long buffer, so it is a hash aggregate
    combined map-side (string min/max buffers would force a sort of every
    fact).  The string min/max then run over that tiny table."""
    return merged_catalog(concept_triples(facts))


def concept_triples(facts: DataFrame) -> DataFrame:
    """(concept_cd, provider_id, valtype_cd, n): what a catalog needs of some
    facts.  The triples of several sets of facts together give the catalog of
    all of them, so a load counts its own facts only."""
    return (facts.groupBy("concept_cd", "provider_id", "valtype_cd")
            .agg(F.count(F.lit(1)).alias("n")))


def merged_catalog(triples: DataFrame) -> DataFrame:
    """The concept catalog from triples, of one load or of many."""
    return (triples.groupBy("concept_cd")
            .agg(F.min("valtype_cd").alias("valtype_cd"),
                 (F.min("valtype_cd") != F.max("valtype_cd")).alias("mixed_valtype"),
                 F.sum("n").alias("n_facts"),
                 F.min("provider_id").alias("provider_id")))


def cde_frame(concept_dimension: DataFrame, source: str = "CDE") -> DataFrame:
    """CDE concepts ordered by upload_id (then concept_cd for a total order)."""
    return (concept_dimension.filter(F.col("sourcesystem_cd") == source)
            .select("concept_cd", "upload_id"))


def cde_list(concept_dimension: DataFrame, source: str = "CDE") -> list[str]:
    """Ordered CDE column names.  The concept dimension is a dictionary of
    column names (hundreds of rows); it is the only list collected."""
    rows = (cde_frame(concept_dimension, source).orderBy("upload_id", "concept_cd")
            .limit(MAX_PIVOT_COLUMNS + 1).collect())   # bounded fetch
    if len(rows) > MAX_PIVOT_COLUMNS:
        raise ValueError(f"more than {MAX_PIVOT_COLUMNS} CDE columns")
    out: list[str] = []
    seen: set[str] = set()
    for r in rows:
        if r.concept_cd is not None and r.concept_cd not in seen:
            out.append(r.concept_cd)
            seen.add(r.concept_cd)
    return out


@dataclass(frozen=True)
class Catalog:
    """Collected concept catalog: value type per concept and the dataset constant."""

    valtypes: dict[str, str]          # concept → 'N' | 'T' | 'MIXED'
    dataset_const: str | None

    @classmethod
    def collect(cls, facts: DataFrame, max_columns: int = MAX_PIVOT_COLUMNS) -> "Catalog":
        """From one pass over the facts."""
        return cls.of(concept_catalog(facts), max_columns)

    @classmethod
    def of(cls, catalog: DataFrame, max_columns: int = MAX_PIVOT_COLUMNS) -> "Catalog":
        """From a concept catalog, such as a mart stores.  More than
        ``max_columns`` concepts are refused, so the fetch is bounded."""
        rows = catalog.limit(max_columns + 1).collect()
        if len(rows) > max_columns:
            raise ValueError(f"more than {max_columns} distinct concepts to pivot")
        vt: dict[str, str] = {}
        providers = []
        for r in rows:
            if r.concept_cd is None:
                continue
            vt[r.concept_cd] = "MIXED" if r.mixed_valtype else r.valtype_cd
            if r.provider_id is not None:
                providers.append(r.provider_id)
        return cls(valtypes=vt, dataset_const=min(providers) if providers else None)


# ------------------------------------------------------------------ pivot --

def winner_struct(*order: Column, value: Column) -> Column:
    """Ordering struct whose maximum is the winning fact; ``v`` is the value."""
    return F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], value.alias("v"))


def winning_cells(cells: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """(key…, concept_cd, v) with one winner per cell: ``max(w)`` over the ordering
    struct, a partial aggregate (hot keys are combined map-side)."""
    return (cells.groupBy(*key_cols, "concept_cd").agg(F.max("w").alias("w"))
            .select(*key_cols, "concept_cd", F.col("w.v").alias("v")))


def pivot_cells(cells: DataFrame, key_cols: Sequence[str], concepts: Sequence[str], beside: DataFrame | None = None,
                on: Column | None = None) -> DataFrame:
    """Wide table, one column per listed concept (values given, so no extra
    distinct job); input cells must already be unique per (key, concept).  Cells
    are gathered by key, one map of its few cells a key, and spread over columns
    last: an aggregate with an expression a column would evaluate all of them for
    every cell, and a wide row would be sorted and joined.  ``beside``: rows that
    the wide ones are joined to by ``on`` before they are spread; each keeps its
    place, with cells or without."""
    if not concepts:
        wide = cells.select(*key_cols).distinct()
        return wide if beside is None else beside.join(wide, on, "left")
    # The place of a listed concept is shorter than its name, and found faster.
    place = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(concepts) for x in (c, i)]), F.col("concept_cd"))
    gathered = (cells.select(*[qcol(k) for k in key_cols], place.alias("__place"), "v")
                .repartition(*[qcol(k) for k in key_cols]).groupBy(*key_cols)
                .agg(F.map_from_entries(F.collect_list(F.when(F.col("__place").isNotNull(), F.struct("__place", "v")))).alias("__cells")))
    rows = gathered if beside is None else beside.join(gathered, on, "left")
    kept = [c for c in rows.columns if c != "__cells"]
    return rows.select(*[qcol(c) for c in kept], *[F.element_at("__cells", F.lit(i)).alias(c) for i, c in enumerate(concepts)])
