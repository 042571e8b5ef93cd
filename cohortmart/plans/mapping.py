"""Declarative source-to-target mappings (``MappingSpec``) compiled to DataFrame plans.

A spec names source tables under aliases (the same table may appear under
several aliases), mandatory equi-join conditions between aliases, an optional
selection condition, and per target table the expression of every target
column.  For each target the aliases its columns use are joined along the
declared conditions among them (inner joins; a target whose aliases are not
connected is refused rather than turned into a cross product), filtered,
projected, and optionally de-duplicated.  Catalyst plans the joins.

A target's driver may be an ``UnpivotSpec`` in place of a table: its wide rows
are joined, and melted behind the last shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmart.functions.columns import qcol
from cohortmart.operators.identity import sequence_ids, sequence_melted
from cohortmart.operators.reshape import UnpivotSpec, melted_row

Resolver = Callable[[str, str], Column]


@dataclass(frozen=True)
class Copy:
    """Target column = source column ``alias.column``."""
    alias: str
    column: str


@dataclass(frozen=True)
class Const:
    value: object
    type: str | None = None


@dataclass(frozen=True)
class Expr:
    """Target column = ``fn(c)`` where ``c(alias, column)`` resolves a source column."""
    aliases: tuple[str, ...]
    fn: Callable[[Resolver], Column]


@dataclass(frozen=True)
class LoadTime:
    """The load timestamp (one value per query)."""


@dataclass(frozen=True)
class Sequence_:
    """Dense row number starting at ``offset + 1`` in the order of the given target
    columns; an empty ``order_by`` numbers rows in stored order (cheapest: no
    range shuffle or sort, ids unique and dense but not reproducible).  ``ranges``:
    into how many ranges of the order melted rows are dealt, by default as many
    as the size of their wide rows asks for."""
    order_by: tuple[str, ...] = ()
    offset: int = 0
    ranges: int | None = None


Source = Copy | Const | Expr | LoadTime | Sequence_


@dataclass(frozen=True)
class Join:
    left: tuple[str, str]   # (alias, column)
    right: tuple[str, str]


@dataclass(frozen=True)
class Target:
    name: str
    columns: tuple[tuple[str, Source], ...]
    distinct: bool = False
    driver: str | None = None     # alias of the large source, joined last


@dataclass(frozen=True)
class MappingSpec:
    sources: Mapping[str, str]                 # alias → source table name
    joins: Sequence[Join] = ()
    targets: Sequence[Target] = ()
    where: Callable[[Resolver], Column] | None = None
    where_aliases: tuple[str, ...] = ()
    typed: Mapping[str, Mapping[str, str]] = field(default_factory=dict)  # target → col → type


def _aliases(src: Source) -> set[str]:
    if isinstance(src, Copy):
        return {src.alias}
    if isinstance(src, Expr):
        return set(src.aliases)
    return set()


def _prefixed(alias: str, df: DataFrame | UnpivotSpec) -> DataFrame:
    if isinstance(df, UnpivotSpec):  # its wide rows
        kinds = {c: qcol(c).cast(df.value_type) if df.value_type else qcol(c) for c in df.values}
        return df.source.select(*[qcol(c).alias(f"{alias}__{df.id_aliases.get(c, c)}") for c in df.ids],
                                *[kind.alias(_wide(alias, i)) for i, kind in enumerate(kinds.values())])
    return df.select(*[qcol(c).alias(f"{alias}__{c}") for c in df.columns])


def _resolver(alias: str, column: str) -> Column:
    return qcol(f"{alias}__{column}")


def _wide(alias: str, i: int) -> str:
    return f"{alias}__value_{i}"


def _classes(joins: Sequence[Join]) -> list[set[tuple[str, str]]]:
    """Equivalence classes of (alias, column) under the inner equi-join conditions."""
    classes: list[set[tuple[str, str]]] = []
    for j in joins:
        hit = [c for c in classes if j.left in c or j.right in c]
        merged = {j.left, j.right}.union(*hit) if hit else {j.left, j.right}
        classes = [c for c in classes if c not in hit] + [merged]
    return classes


def _with_bridges(spec: MappingSpec, aliases: set[str]) -> set[str]:
    """The aliases and those that a shortest chain of declared joins needs to
    connect them."""
    near: dict[str, set[str]] = {}
    for c in _classes(spec.joins):
        for a, _ in c:
            near.setdefault(a, set()).update(b for b, _ in c if b != a)
    order = sorted(aliases, key=list(spec.sources).index)
    joined = {order[0]}
    for goal in order[1:]:
        paths, seen = [[a] for a in sorted(joined)], set(joined)
        while paths and goal not in joined:
            path = paths.pop(0)
            if path[-1] == goal:
                joined.update(path)
                break
            for b in sorted(near.get(path[-1], ())):
                if b not in seen:
                    seen.add(b)
                    paths.append([*path, b])
        if goal not in joined:
            return aliases  # not connected at all: refused where the joins are built
    return joined


def _join_aliases(spec: MappingSpec, aliases: set[str], tables: Mapping[str, DataFrame | UnpivotSpec],
                  driver: str | None = None) -> DataFrame:
    """Inner-join the aliases along the declared equalities and their transitive
    closure (a = b and a = c imply b = c).  With a ``driver`` alias (the large
    source) the other aliases are joined first and the driver last, so the
    large side is shuffled once on its join key; of the others those that share
    no key with the driver come first, so that the rest meets it as it lies."""
    declared = list(spec.sources)
    classes = [{m for m in c if m[0] in aliases} for c in _classes(spec.joins)]
    classes = [c for c in classes if len(c) > 1]
    beside = {a for c in classes if driver in {m[0] for m in c} for a, _ in c}
    order = sorted(aliases - ({driver} if driver else set()), key=lambda a: (a in beside, declared.index(a)))
    if driver:
        order.append(driver)
    done = {order[0]}
    df = _prefixed(order[0], tables[spec.sources[order[0]]])
    remaining = order[1:]
    while remaining:
        for new in remaining:
            if new == driver and len(remaining) > 1:
                continue
            conds = []
            for c in classes:
                mine = sorted(m for m in c if m[0] == new)
                theirs = sorted(m for m in c if m[0] in done)
                if mine and theirs:
                    conds.append(_resolver(*mine[0]) == _resolver(*theirs[0]))
                    # several columns of the new alias in one class: equal to each other too
                    conds += [_resolver(*mine[0]) == _resolver(*x) for x in mine[1:]]
            if conds:
                cond = conds[0]
                for c2 in conds[1:]:
                    cond = cond & c2
                df = df.join(_prefixed(new, tables[spec.sources[new]]), cond, "inner")
                done.add(new)
                remaining.remove(new)
                break
        else:
            raise ValueError(f"aliases {remaining} are not joined to {sorted(done)}; "
                             "a mapping never builds a cross product")
    return df


class Targets(Mapping):
    """Target name → DataFrame, built on first access.  A target with a
    ``Sequence_`` column runs its numbering job only when it is asked for."""

    def __init__(self, build: Callable[[Target], DataFrame], targets: Sequence[Target]):
        self._build = build
        self._targets = {t.name: t for t in targets}
        self._done: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._done:
            self._done[name] = self._build(self._targets[name])
        return self._done[name]

    def __iter__(self):
        return iter(self._targets)

    def __len__(self) -> int:
        return len(self._targets)


def run_mapping(spec: MappingSpec, tables: Mapping[str, DataFrame | UnpivotSpec],
                load_time: Column | None = None) -> Targets:
    """Compile every target to a DataFrame (lazily, on first access)."""
    now = load_time if load_time is not None else F.current_timestamp()
    if spec.where is not None and not any(
            set(spec.where_aliases) <= set().union(*(_aliases(src) for _, src in t.columns)) for t in spec.targets):
        raise ValueError(f"no target reads all of {spec.where_aliases}: the selection would never apply")

    def build(t: Target) -> DataFrame:
        used: set[str] = set()
        for _, src in t.columns:
            used |= _aliases(src)
        if not used:
            raise ValueError(f"target {t.name} reads no source")
        needed = _with_bridges(spec, used)
        df = _join_aliases(spec, needed, tables, t.driver if t.driver in used else None)
        # the selection condition restricts its source aliases: it applies to the
        # targets that read all of them and leaves the others untouched
        if spec.where is not None and set(spec.where_aliases) <= used:
            df = df.filter(spec.where(_resolver))
        melted = t.driver if t.driver in used and isinstance(tables[spec.sources[t.driver]], UnpivotSpec) else None
        wide = tables[spec.sources[melted]] if melted else None
        cell = {f"{melted}__{wide.attribute_col}", f"{melted}__{wide.value_col}"} if melted else set()
        late: dict[str, set[str]] = {}       # columns that read a melted cell, and what they read
        seq: tuple[str, Sequence_] | None = None
        data: dict[str, Column] = {}         # columns read from the sources
        consts: dict[str, Column] = {}       # constants and the load time
        for name, src in t.columns:
            read: set[str] = set()

            def resolve(alias: str, column: str) -> Column:
                read.add(f"{alias}__{column}")
                return _resolver(alias, column)

            if isinstance(src, Copy):
                c = resolve(src.alias, src.column)
            elif isinstance(src, Const):
                c = F.lit(src.value)
                if src.type:
                    c = c.cast(src.type)
            elif isinstance(src, Expr):
                c = src.fn(resolve)
            elif isinstance(src, LoadTime):
                c = now
            elif isinstance(src, Sequence_):
                seq = (name, src)
                continue
            else:
                raise TypeError(f"unknown column source {src!r}")
            ty = spec.typed.get(t.name, {}).get(name)
            c = (c.cast(ty) if ty else c).alias(name)
            if isinstance(src, (Const, LoadTime)) and not t.distinct:
                consts[name] = c
            else:
                data[name] = c
                if read & cell:
                    late[name] = read
        if seq is not None:
            # numbering materializes its input: carry only source-derived columns
            # through it and add the constants afterwards
            data |= {n: c for n, c in consts.items() if n in seq[1].order_by}
            consts = {n: c for n, c in consts.items() if n not in seq[1].order_by}
        if melted:
            early = [c for n, c in data.items() if n not in late]
            carried = sorted(set().union(*late.values()) - cell)
            df = df.select(*early, *[qcol(c) for c in carried], *[qcol(_wide(melted, i)) for i in range(len(wide.values))])
            of = melted_row({n: qcol(_wide(melted, i)) for i, n in enumerate(wide.values)},
                            f"{melted}__{wide.attribute_col}", f"{melted}__{wide.value_col}", wide.drop_nulls)

            def melt(rows: DataFrame) -> DataFrame:
                kept = [n for n in data if n not in late]
                more = [c for c in rows.columns if c == "__pid"]
                return of(rows, [*kept, *carried, *more]).select(*[data[n] if n in late else qcol(n) for n in data], *more)
        else:
            df = df.select(*data.values())
        lead: list[str] = []
        if melted and seq is not None:
            for n in seq[1].order_by:
                if n in late:
                    break
                lead.append(n)
        if melted and seq is not None and not t.distinct and (lead or not seq[1].order_by):
            df = sequence_melted(df, melt, lead, seq[1].order_by, seq[0], start=seq[1].offset, ranges=seq[1].ranges)
        else:
            df = melt(df) if melted else df
            if t.distinct:
                df = df.distinct()
            if seq is not None:
                name, s = seq
                df = sequence_ids(df, s.order_by, name, start=s.offset)
        return df.select(*[consts[n] if n in consts else qcol(n) for n, _ in t.columns])

    return Targets(build, spec.targets)
