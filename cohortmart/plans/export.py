"""Flattening exports: EAV star schema → one wide row per patient or visit.

Strategies (all lazy DataFrames; the only driver-side data are the column
names of the concept dictionary and catalog):

* ``mindate`` / ``maxdate`` — one row per patient code, facts of all visits on
  the patient's first / last date.
* ``longitude`` — one row per (patient code, visit code), facts of that visit.
* ``6months`` — first MRI visit, a valid diagnosis within a window of it, the
  MMSE/MoCA visits nearest that diagnosis; facts of those ≤4 visits, the MRI
  visit winning, then diagnosis, MMSE, MoCA.

Plan shape (every strategy and width): the strategy yields one row per (key,
selected encounter) carrying the key's demographic candidate, written once.
These rows are joined to the fact table on encounter_num - the one shuffle of
the large table, after column pruning, the writable-fact filter and, where a
strategy selects some encounters only, a bitmap of these (none when
the facts are bucketed on encounter_num); the join is inner so AQE can split a
hot encounter.  A partial aggregate leaves one winner per (key, concept), so a
key holding a third of all facts is reduced in every map task; the pivot then
gathers the winners of a key, joins them to the demographics of the keys, so that
keys without facts keep their row, and writes each into its cell last.  Where every key has one selected
row (``longitude``), a number of that row stands for the key on the way, and
values are rendered when their cell is won.  Nothing per patient passes through
the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cohortmart.functions.columns import (
    DEC, VALTYPE_NUMERIC, VALTYPE_TEXT, age_group, age_months, age_years, qcol, set_or_append, typed_value, valid_valtype,
    writable_fact)
from cohortmart.functions.hashing import hash_column
from cohortmart.operators.identity import in_bitmap
from cohortmart.operators.reshape import Catalog, cde_list, pivot_cells, winner_struct
from cohortmart.operators.visits import (
    AS_CODED_WINDOW_SECONDS, DEFAULT_WINDOW_SECONDS, DIAGNOSIS_CONCEPT, MMSE_CONCEPT, MOCA_CONCEPT, cognitive_visits, diagnosis_candidates,
    first_mri, nearest_diagnosis, stack_encounters, valid_diagnosis_encounters,
    visits_at_extreme)
from cohortmart.schema import Mart
from cohortmart.session import ensure_checkpoint_dir, is_case_sensitive

# --- fixed values: demographic columns every export carries ---------------
DEMOGRAPHICS = ("subjectageyears", "subjectage", "gender", "dataset", "agegroup")
DATASET_COLUMN = "Dataset"
OUTCOME, ACCEPTED, NULL_DEMOGRAPHICS = "outcome", "accepted", "NULL age, gender or dataset"
SIX_MONTH_ROLES = ("encounter_num_mri", "encounter_num_diag", "encounter_num_mmse",
                   "encounter_num_moca")
# --------------------------------------------------------------------------
#: Bitmap slots for each selected encounter, and how many there may be (32 MB).
SLOTS, MOST_SLOTS = 64, 1 << 28


@dataclass(frozen=True)
class ExportOptions:
    """Knobs of the exports; defaults follow the documented intent.

    ``window_seconds``/``pick``/``exclude_diagnoses`` apply to ``6months``.
    ``null_policy``: ``fail`` (a NULL age, gender or dataset fails the job, as
    the reference aborts), ``keep`` or ``drop`` the row, or ``tag`` every row
    with its ``outcome`` (``ACCEPTED`` or ``NULL_DEMOGRAPHICS``), so that one
    write can deal accepted and rejected rows to folders of their own.
    ``valtype_policy``: ``strict`` fails on a selected fact whose value type is
    neither N nor T; ``lenient`` skips and counts it (see quality.bad_valtype).
    ``dataset_const``: value of the ``dataset`` column, default the smallest
    provider_id of the facts.  ``dataset``: when set, a ``Dataset`` column with
    this value is set or appended (needs a case-sensitive session because the
    export also has ``dataset``).  ``checkpoint_selection``: the selected rows
    feed both the fact join and the demographics; they are written once to the
    shared checkpoint folder instead of being computed twice.
    ``key_policy``: ``fail`` (two encounters with one longitudinal key stop the
    export) or ``merge`` (their facts fill one row, demographics of the
    greatest encounter).  ``hash_ids``: hash method for the key columns of the
    result; visits and winners are chosen on the raw ids.
    """

    window_seconds: int = DEFAULT_WINDOW_SECONDS
    pick: str = "closest"
    exclude_diagnoses: tuple[str, ...] = ("NA",)
    null_policy: str = "fail"
    valtype_policy: str = "strict"
    dataset_const: str | None = None
    dataset: str | None = None
    checkpoint_selection: bool = True
    key_policy: str = "fail"
    hash_ids: str | None = None


DEFAULT = ExportOptions()
# Behaviour of the reference scripts as written (30-day window, farthest
# valid diagnosis, "NA" accepted).
AS_CODED = ExportOptions(window_seconds=AS_CODED_WINDOW_SECONDS, pick="farthest",
                         exclude_diagnoses=())


@dataclass(frozen=True)
class Selection:
    """What a strategy hands to the common assembly.

    ``rows``: (key…, leading…, encounter_num, role_rank, age, sex_cd,
    tiebreak) — one row per key and selected encounter; facts of that
    encounter fill the key's row, and of the demographic candidates of a key
    the one with the greatest ``tiebreak`` wins.
    """

    key_cols: tuple[str, ...]
    leading_cols: tuple[str, ...]
    rows: DataFrame
    integer_months: bool = False
    prefer_nonempty: bool = False
    one_row_per_key: bool = False
    some_encounters: bool = True  # not every encounter is selected


@dataclass(frozen=True)
class ExportResult:
    frame: DataFrame
    cells: DataFrame          # (key…, concept_cd, w) before the winner reduction
    facts: Observation | None  # of the facts that the frame writes: their number, ``updates``
    key_cols: tuple[str, ...]
    columns: tuple[str, ...]
    n_cde_columns: int
    keys: DataFrame           # the key columns of the frame's rows, from the selection alone
    tagged: bool = False      # the frame has an ``outcome``
    lenient: bool = False     # facts of bad value types are skipped and counted

    def observed(self) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
        """The frame, and the counters of its run: CDE columns, inserted rows and
        written facts.  Both counts are taken while the frame is computed (by
        whatever writes it), so they cost no pass of their own; ask for them
        when the write is done."""
        if self.facts is None:
            raise ValueError("this export does not observe its facts")
        rows = Observation()
        accepted = F.col(OUTCOME) == ACCEPTED if self.tagged else F.lit(True)
        counts = [F.count(F.when(accepted, 1)).alias("inserts")]
        if self.tagged:
            counts.append(F.count(F.when(~accepted, 1)).alias("rejected_subjects"))
        frame = self.frame.observe(rows, *counts)

        def counters() -> dict[str, int]:
            # An export without any row never starts its plan's tasks.
            found = {"cde_columns": self.n_cde_columns, "inserts": rows.get.get("inserts"), "updates": self.facts.get.get("updates")}
            if self.lenient:
                found["skipped_facts"] = self.facts.get.get("skipped")
            if self.tagged:
                found["rejected_subjects"] = rows.get.get("rejected_subjects")
            return {k: int(v or 0) for k, v in found.items()}

        return frame, counters

    def counters(self) -> DataFrame:
        """The counters as a (counter, value) table, from one run of the export
        whose rows go nowhere."""
        frame, counters = self.observed()
        frame.write.format("noop").mode("overwrite").save()
        return self.frame.sparkSession.createDataFrame(list(counters().items()), "counter string, value long")


# ------------------------------------------------------------- strategies --

def _pm(mart: Mart) -> DataFrame:
    return mart.patient_mapping.select(F.col("patient_ide").alias("subjectcode"), "patient_num")


def _pd(mart: Mart) -> DataFrame:
    return mart.patient_dimension.select("patient_num", "sex_cd")


def select_extreme(mart: Mart, which: str) -> Selection:
    visits = mart.visit_dimension.select("patient_num", "encounter_num", "start_date",
                                         "patient_age")
    sel = visits_at_extreme(visits, which).join(_pm(mart), "patient_num").join(_pd(mart),
                                                                               "patient_num")
    rows = sel.select("subjectcode", "encounter_num", F.lit(0).alias("role_rank"),
                      F.col("patient_age").alias("age"), "sex_cd",
                      F.struct("encounter_num", "patient_num").alias("tiebreak"))
    return Selection(("subjectcode",), (), rows)


def select_longitudinal(mart: Mart) -> Selection:
    em = mart.encounter_mapping.select(F.col("patient_ide").alias("subjectcode"),
                                       F.col("encounter_ide").alias("subjectvisitid"),
                                       "encounter_num")
    vd = mart.visit_dimension.select("encounter_num", "patient_num", "start_date", "patient_age")
    rows = (em.join(vd, "encounter_num").join(_pd(mart), "patient_num")
            .select("subjectcode", "subjectvisitid",
                    F.col("start_date").alias("subjectvisitdate"), "encounter_num",
                    F.lit(0).alias("role_rank"), F.col("patient_age").alias("age"), "sex_cd",
                    F.struct("encounter_num", "patient_num").alias("tiebreak")))
    return Selection(("subjectcode", "subjectvisitid"), ("subjectvisitdate",), rows,
                     integer_months=True, one_row_per_key=True, some_encounters=False)


def six_month_selection(mart: Mart, opts: ExportOptions) -> DataFrame:
    """Per patient: MRI, diagnosis (with age), MMSE and MoCA encounters."""
    visits = mart.visit_dimension.select("patient_num", "encounter_num", "start_date",
                                         "patient_age", "location_cd")
    # One pass over the facts for the three concepts that the selection reads.
    facts = (mart.observation_fact.filter(F.col("concept_cd").isin(DIAGNOSIS_CONCEPT, MMSE_CONCEPT, MOCA_CONCEPT))
             .select("patient_num", "encounter_num", "start_date", "concept_cd", "tval_char"))
    if opts.checkpoint_selection:
        ensure_checkpoint_dir(facts.sparkSession)
        facts = facts.checkpoint(eager=True)
    mri = first_mri(visits)
    valid = valid_diagnosis_encounters(facts, exclude_values=opts.exclude_diagnoses)
    cand = diagnosis_candidates(visits, mri, valid, opts.window_seconds)
    diag = nearest_diagnosis(cand, opts.pick)
    return cognitive_visits(facts, diag, opts.window_seconds)


def select_six_months(mart: Mart, opts: ExportOptions) -> Selection:
    tt = six_month_selection(mart, opts)
    if opts.checkpoint_selection:
        tt = tt.checkpoint(eager=True)
    demo = tt.select("patient_num", F.col("age_diag").alias("age"), "encounter_num_diag")
    rows = (stack_encounters(tt, SIX_MONTH_ROLES).join(demo, "patient_num")
            .join(_pm(mart), "patient_num").join(_pd(mart), "patient_num")
            .select("subjectcode", "encounter_num", "role_rank", "age", "sex_cd",
                    F.struct("encounter_num_diag", "patient_num").alias("tiebreak")))
    return Selection(("subjectcode",), (), rows, prefer_nonempty=True)


def selection_for(mart: Mart, strategy: str, opts: ExportOptions) -> Selection:
    if strategy == "mindate":
        return select_extreme(mart, "min")
    if strategy == "maxdate":
        return select_extreme(mart, "max")
    if strategy == "longitude":
        return select_longitudinal(mart)
    if strategy == "6months":
        return select_six_months(mart, opts)
    raise ValueError(f"unknown strategy {strategy!r}; expected one of {sorted(STRATEGIES)}")


STRATEGIES = ("mindate", "maxdate", "6months", "longitude")


# ------------------------------------------------------------ assembly ----

def column_layout(cdes: Sequence[str], valtypes: dict[str, str],
                  reserved: Sequence[str]) -> list[tuple[str, str]]:
    """(name, kind) after the key: CDEs in upload order (text), demographics
    missing from the CDE list, then other concepts ascending — ``num`` for a
    purely numeric concept, else ``text``.  Membership is exact."""
    seen = set(reserved)
    out: list[tuple[str, str]] = []
    for c in cdes:
        if c not in seen:
            out.append((c, "cde"))
            seen.add(c)
    for d in DEMOGRAPHICS:
        if d not in seen:
            out.append((d, "cde"))
            seen.add(d)
    for c in sorted(valtypes):
        if c not in seen:
            out.append((c, "num" if valtypes[c] == "N" else "text"))
            seen.add(c)
    return out


def _check_case(names: Sequence[str], spark) -> None:
    if is_case_sensitive(spark):
        return
    low: dict[str, str] = {}
    for n in names:
        if n.lower() in low and low[n.lower()] != n:
            raise ValueError(f"columns {low[n.lower()]!r} and {n!r} differ only by case; "
                             "set spark.sql.caseSensitive=true")
        low[n.lower()] = n


def _joined(mart: Mart, sel: Selection, opts: ExportOptions) -> DataFrame:
    """Selected rows joined to their writable facts, with the ordering struct
    ``w`` of each fact."""
    vt, nval = F.col("valtype_cd"), F.col("nval_num")
    if opts.valtype_policy not in ("strict", "lenient"):
        raise ValueError("valtype_policy must be 'strict' or 'lenient'")
    bad = ~valid_valtype(vt) | vt.isNull()  # seen if a selected encounter has them: to fail, or to be counted
    keep = writable_fact(vt, nval) | bad
    # Inner join: AQE can split a hot encounter on the fact side and may
    # broadcast a small row set; rows without facts are added back by a union
    # in ``export`` so every key keeps its row.
    # Only what a cell needs is joined: a number, or a text (of a bad fact its type).
    text = F.when(bad, F.coalesce(vt, F.lit("NULL"))).when(vt == VALTYPE_TEXT, F.coalesce(F.col("tval_char"), F.lit("")))
    facts = mart.observation_fact.filter(keep & F.col("concept_cd").isNotNull()).select(
        "encounter_num", "concept_cd", "instance_num", bad.alias("bad"), F.when(~bad & (vt == VALTYPE_NUMERIC), nval).alias("number"), text.alias("text"))
    if sel.some_encounters and opts.checkpoint_selection:
        # Most facts are of other encounters: a bitmap of the selected ones (some
        # slots each, so that few others pass) keeps them out of the shuffle.
        bits = min(max(1 << (SLOTS * sel.rows.count()).bit_length(), 1 << 20), MOST_SLOTS)
        facts = in_bitmap(facts, sel.rows.select("encounter_num"), ["encounter_num"], bits)
    joined = sel.rows.join(facts, "encounter_num", "inner")
    if opts.valtype_policy == "strict":
        joined = joined.withColumn("text", F.when(F.col("bad"), F.raise_error(F.concat(
            F.lit("unsupported valtype_cd in a selected fact: "), F.col("text"))).cast("string")).otherwise(F.col("text")))
    joined = joined.withColumn("v", _rendered(F.col("number"), F.col("text"), F.col("bad") if opts.valtype_policy == "lenient" else None))
    nonempty = (F.col("v") != F.lit("")).cast("int") if sel.prefer_nonempty else F.lit(0)
    w = winner_struct(nonempty, -F.col("role_rank"), F.col("encounter_num"),
                      F.col("instance_num"), F.col("number"), value=F.col("v"))
    return joined.withColumn("w", w)


def _rendered(number: Column, text: Column, bad: Column | None = None) -> Column:
    """The cell of a fact, from its number or else its text; NULL of a bad one."""
    text = text if bad is None else F.when(~bad, text)
    return F.when(number.isNotNull(), typed_value(F.lit(VALTYPE_NUMERIC), F.lit(None), number)).otherwise(text)


def _demographic_columns(best: DataFrame, sel: Selection, key: str, opts: ExportOptions,
                         dataset_const: str | None) -> tuple[DataFrame, dict[str, object], Column]:
    """Apply the NULL policy and return the rendered demographic expressions."""
    age, sex = F.col("__demo.age"), F.col("__demo.sex_cd")
    ds = F.lit(dataset_const).cast("string")
    bad = age.isNull() | sex.isNull() | ds.isNull()
    if opts.null_policy == "fail":
        best = best.filter(F.when(bad, F.raise_error(F.concat(
            F.lit("NULL value in age, gender or dataset for subject: "),
            F.coalesce(F.col(key).cast("string"), F.lit("NULL"))))).otherwise(F.lit(True)))
    elif opts.null_policy == "drop":
        best = best.filter(~bad)
    elif opts.null_policy not in ("keep", "tag"):
        raise ValueError("null_policy must be 'fail', 'keep', 'drop' or 'tag'")
    months = age_months(age)
    years = age_years(age)
    exprs = {
        "subjectageyears": years.cast("string"),
        "subjectage": (months.cast("long") if sel.integer_months else months.cast(DEC)).cast("string"),
        "gender": sex,
        "dataset": ds,
        "agegroup": age_group(years),
    }
    return best, exprs, F.when(bad, NULL_DEMOGRAPHICS).otherwise(ACCEPTED)


def export(mart: Mart, strategy: str, options: ExportOptions = DEFAULT,
           catalog: Catalog | None = None, cdes: Sequence[str] | None = None, observe: bool = True) -> ExportResult:
    """Build the flat export of ``strategy`` over ``mart`` (lazy).  Without
    ``observe`` its facts are not counted while it runs."""
    opts = options
    spark = mart.observation_fact.sparkSession
    if catalog is None:
        catalog = Catalog.of(mart.catalog) if mart.catalog is not None else Catalog.collect(mart.observation_fact)
    if cdes is None:
        cdes = cde_list(mart.concept_dimension)
    sel = selection_for(mart, strategy, opts)
    reserved = [*sel.key_cols, *sel.leading_cols]
    layout = column_layout(cdes, catalog.valtypes, reserved)
    names = [*reserved, *[n for n, _ in layout]]
    _check_case(names, spark)
    dataset_const = opts.dataset_const if opts.dataset_const is not None else catalog.dataset_const

    if opts.checkpoint_selection:
        ensure_checkpoint_dir(spark)
        sel = replace(sel, rows=sel.rows.checkpoint(eager=True))
    # A key that may have one row only: the row's number (fixed, as the rows are
    # written) is shorter than the codes.
    numbered = sel.one_row_per_key and opts.key_policy == "fail" and opts.checkpoint_selection and not sel.prefer_nonempty
    if numbered:
        sel = replace(sel, rows=sel.rows.withColumn("__row", F.monotonically_increasing_id()))
    joined = _joined(mart, sel, opts)
    keys = {k: f"__k{i}" for i, k in enumerate(sel.key_cols)}
    held = ["__row"] if numbered else list(keys.values())
    renamed = ["__row"] if numbered else [qcol(k).alias(v) for k, v in keys.items()]
    # One plan for every width: one winner per (key, concept), then one cell per concept.
    facts_seen = Observation()
    # A written fact has a rendered value; counting it applies the value type policy.
    won = F.struct("instance_num", "number", "text") if numbered else F.col("w")
    counts = [F.count(F.when(~F.col("bad"), _rendered(F.col("w.number"), F.col("w.text")) if numbered else F.col("w.v"))).alias("updates")]
    lenient = opts.valtype_policy == "lenient"
    if lenient:
        counts.append(F.count(F.when(F.col("bad"), 1)).alias("skipped"))
    seen = joined.select(*renamed, "concept_cd", won.alias("w"), "bad")
    if observe:
        seen = seen.observe(facts_seen, *counts)
    value = _rendered(F.col("w.number"), F.col("w.text")) if numbered else F.col("w.v")
    winners = ((seen.filter(~F.col("bad")) if lenient else seen).groupBy(*held, "concept_cd")
               .agg(F.max("w").alias("w")).select(*held, "concept_cd", value.alias("v")))
    demo = F.struct("tiebreak", *sel.leading_cols, "age", "sex_cd", *(held if numbered else ()))
    best = (sel.rows.select(*[qcol(k).alias(f"__d{v}") for k, v in keys.items()], demo.alias("__demo"))
            .groupBy(*[f"__d{v}" for v in keys.values()])
            .agg(F.max("__demo").alias("__demo"), F.count(F.lit(1)).alias("__n")))
    if sel.one_row_per_key:
        if opts.key_policy == "fail":
            first = F.col(f"__d{keys[sel.key_cols[0]]}").cast("string")
            best = best.filter(F.when(F.col("__n") > 1, F.raise_error(F.concat(
                F.lit("more than one encounter for a key of subject: "),
                F.coalesce(first, F.lit("NULL"))))).otherwise(F.lit(True)))
        elif opts.key_policy != "merge":
            raise ValueError("key_policy must be 'fail' or 'merge'")
    on = ([F.col("__demo.__row") == F.col("__row")] if numbered else
          [F.col(f"__d{v}").eqNullSafe(F.col(v)) for v in keys.values()])
    best = pivot_cells(winners, held, [n for n, _ in layout], best, reduce(and_, on)).drop(*held)
    best = best.withColumnsRenamed({f"__d{v}": v for v in keys.values()})
    best, demo_expr, outcome = _demographic_columns(best, sel, keys[sel.key_cols[0]], opts, dataset_const)

    out_cols = [(hash_column(F.col(v), opts.hash_ids) if opts.hash_ids else F.col(v)).alias(k) for k, v in keys.items()]
    out_keys = [(hash_column(qcol(k), opts.hash_ids) if opts.hash_ids else qcol(k)).alias(k) for k in keys]
    out_cols += [F.col(f"__demo.{c}").alias(c) for c in sel.leading_cols]
    for name, kind in layout:
        f = qcol(name)
        if name in DEMOGRAPHICS:
            out_cols.append(F.coalesce(f, demo_expr[name]).alias(name))
        elif kind == "num":
            out_cols.append(f.cast(DEC).alias(name))
        else:
            out_cols.append(f.alias(name))
    if opts.null_policy == "tag":
        out_cols.append(outcome.alias(OUTCOME))
    frame = best.select(*out_cols)
    if opts.dataset is not None:
        frame = set_or_append(frame, DATASET_COLUMN, opts.dataset)
    n_cde = len([c for c in cdes if c not in reserved])
    facts = (joined.filter(~F.col("bad")) if lenient else joined).select(*sel.key_cols, "concept_cd", "w")
    return ExportResult(frame=frame, cells=facts, facts=facts_seen if observe else None, key_cols=sel.key_cols,
                        columns=tuple(frame.columns), n_cde_columns=n_cde, keys=sel.rows.select(*out_keys).distinct(),
                        tagged=opts.null_policy == "tag", lenient=lenient)


def export_frame(mart: Mart, strategy: str, options: ExportOptions = DEFAULT, **kw) -> DataFrame:
    return export(mart, strategy, options, observe=False, **kw).frame


def with_options(base: ExportOptions, **changes) -> ExportOptions:
    return replace(base, **changes)
