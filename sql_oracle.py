"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Only the raw driver tables are registered in DuckDB, so every statement
starts with the clinical view (FIXTURES.md §3) as CTEs.  Column names and
types match the Spark side: decimals are compared as double (see
``__spark_entry__.for_oracle``), timestamps stay without time zone.
"""

from __future__ import annotations

HOSPITAL = "MockHospital"

VIEWS = f"""
patient_mapping AS (
  SELECT c_name AS patient_ide, '{HOSPITAL}' AS patient_ide_source, '{HOSPITAL}' AS project_id,
         c_custkey AS patient_num
  FROM customer),
patient_dimension AS (
  SELECT c_custkey AS patient_num, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex_cd
  FROM customer),
encounter_mapping AS (
  SELECT concat('V', cast(o_orderkey AS varchar)) AS encounter_ide,
         '{HOSPITAL}' AS encounter_ide_source, '{HOSPITAL}' AS project_id,
         c_name AS patient_ide, '{HOSPITAL}' AS patient_ide_source, o_orderkey AS encounter_num
  FROM orders JOIN customer ON o_custkey = c_custkey),
visit_dimension AS (
  SELECT o_orderkey AS encounter_num, o_custkey AS patient_num, o_orderdate AS start_date,
         cast((4000 + (o_custkey % 55) * 100 + (o_orderkey % 100)) / 100.0 AS decimal(18,5)) AS patient_age,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'MRI' ELSE 'CLINIC' END AS location_cd
  FROM orders),
concept_dimension AS (
  SELECT * FROM (VALUES
    ('subjectageyears', 'CDE', 1), ('subjectage', 'CDE', 2), ('gender', 'CDE', 3),
    ('dataset', 'CDE', 4), ('agegroup', 'CDE', 5), ('DIAG_etiology_1', 'CDE', 6),
    ('minimentalstate', 'CDE', 7), ('montrealcognitiveassessment', 'CDE', 8),
    ('totalprice', 'LOCAL', 9), ('priority', 'LOCAL', 10), ('quantity', 'LOCAL', 11)
  ) t(concept_cd, sourcesystem_cd, upload_id)),
order_facts AS (
  SELECT o_orderkey AS encounter_num, o_custkey AS patient_num, 'DIAG_etiology_1' AS concept_cd,
         o_orderdate AS start_date, 1 AS instance_num, 'T' AS valtype_cd,
         CASE o_orderstatus WHEN 'F' THEN 'Alzheimer' WHEN 'O' THEN 'Diagnostic en attente'
                            WHEN 'P' THEN 'NA' END AS tval_char,
         cast(NULL AS decimal(18,5)) AS nval_num
  FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, 'minimentalstate', o_orderdate, 1, 'N', 'E',
         cast(o_orderkey % 31 AS decimal(18,5))
  FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL
  SELECT o_orderkey, o_custkey, 'montrealcognitiveassessment', o_orderdate, 1, 'N', 'E',
         cast(o_orderkey % 31 AS decimal(18,5))
  FROM orders WHERE o_orderkey % 5 = 0
  UNION ALL
  SELECT o_orderkey, o_custkey, 'totalprice', o_orderdate, 1, 'N', 'E',
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE cast(o_totalprice AS decimal(18,5)) END
  FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, 'priority', o_orderdate, 1, 'T',
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END,
         cast(NULL AS decimal(18,5))
  FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, 'quantity', o_orderdate, l_linenumber, 'N', 'E',
         cast(l_quantity AS decimal(18,5))
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
observation_fact AS (
  SELECT encounter_num, patient_num, concept_cd, '{HOSPITAL}' AS provider_id, start_date,
         '@' AS modifier_cd, instance_num, valtype_cd, tval_char, nval_num
  FROM order_facts)
"""


STAR = ("patient_mapping", "encounter_mapping", "patient_dimension", "visit_dimension",
        "observation_fact")
# Identifier columns hashed by mart anonymization, per view.
ANON_IDS = {
    "patient_mapping": ("patient_ide", "patient_num"),
    "encounter_mapping": ("encounter_ide", "patient_ide", "encounter_num"),
    "patient_dimension": ("patient_num",),
    "visit_dimension": ("encounter_num", "patient_num"),
    "observation_fact": ("encounter_num", "patient_num"),
}


def views(anon: str | None = None) -> str:
    """The clinical view; with ``anon='md5'`` the star views carry hashed ids."""
    if anon is None:
        return VIEWS.strip()
    body = VIEWS
    for t in STAR:
        body = body.replace(f"\n{t} AS (", f"\nraw_{t} AS (")
    extra = []
    for t, ids in ANON_IDS.items():
        cols = ", ".join(f"{anon}(cast({c} AS varchar)) AS {c}" for c in ids)
        extra.append(f"{t} AS (SELECT {cols}, * EXCLUDE ({', '.join(ids)}) FROM raw_{t})")
    return body.strip() + ",\n" + ",\n".join(extra)


def with_views(*ctes: str, select: str, anon: str | None = None) -> str:
    parts = [views(anon)] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + select


# Layout of the fixture exports: CDEs in upload order, then local concepts
# ascending with their kinds.
CDES = ("subjectageyears", "subjectage", "gender", "dataset", "agegroup",
        "DIAG_etiology_1", "minimentalstate", "montrealcognitiveassessment")
LOCALS = (("priority", "text"), ("quantity", "num"), ("totalprice", "num"))
DEMOGRAPHICS = ("subjectageyears", "subjectage", "gender", "dataset", "agegroup")

TYPED_VALUE = ("CASE WHEN f.valtype_cd = 'T' THEN coalesce(f.tval_char, '') "
               "WHEN f.valtype_cd = 'N' THEN cast(cast(f.nval_num AS decimal(18,5)) AS varchar) END")
WRITABLE = "(f.valtype_cd = 'T' OR (f.valtype_cd = 'N' AND f.nval_num IS NOT NULL))"
AGE_GROUP = ("CASE WHEN {y} IS NULL THEN NULL WHEN {y} >= 50 AND {y} < 60 THEN '50-59y' "
             "WHEN {y} >= 60 AND {y} < 70 THEN '60-69y' WHEN {y} >= 70 AND {y} < 90 THEN '70-79y' "
             "WHEN {y} >= 80 THEN '+80y' ELSE '-50y' END")


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _assemble(key_cols: list[str], leading: list[str], integer_months: bool,
              dataset_sql: str = "(SELECT min(provider_id) FROM observation_fact)",
              prefer_nonempty: bool = False, locals_=LOCALS, cdes=CDES) -> tuple[list[str], str]:
    """CTEs ``cells``/``wide`` and the final select over ``members``
    (key…, encounter_num, role_rank) and ``demo`` (key…, leading…, age, sex_cd)."""
    keys = ", ".join(f"m.{k}" for k in key_cols)
    part = ", ".join(f"m.{k}" for k in key_cols)
    nonempty = f"CASE WHEN ({TYPED_VALUE}) <> '' THEN 1 ELSE 0 END DESC, " if prefer_nonempty else ""
    cells = f"""cells AS (
      SELECT * FROM (
        SELECT {keys}, f.concept_cd, {TYPED_VALUE} AS v,
               row_number() OVER (PARTITION BY {part}, f.concept_cd ORDER BY {nonempty}
                 m.role_rank ASC, f.encounter_num DESC, f.instance_num DESC NULLS LAST,
                 CASE WHEN f.valtype_cd = 'N' THEN f.nval_num END DESC NULLS LAST,
                 {TYPED_VALUE} DESC NULLS LAST) AS rn
        FROM observation_fact f JOIN members m ON f.encounter_num = m.encounter_num
        WHERE {WRITABLE}) x WHERE rn = 1)"""
    pivot_names = [c for c in cdes] + [c for c, _ in locals_]
    wide_cols = ",\n        ".join(
        f"max(CASE WHEN concept_cd = '{c}' THEN v END) AS {_q('f_' + c)}" for c in pivot_names)
    kc = ", ".join(key_cols)
    wide = f"""wide AS (
      SELECT {kc},
        {wide_cols}
      FROM cells GROUP BY {kc})"""
    y = "cast(floor(d.age) AS bigint)"
    months = "round((d.age - floor(d.age)) * 12)"
    months_txt = (f"cast(cast({months} AS bigint) AS varchar)" if integer_months
                  else f"cast(cast({months} AS decimal(18,5)) AS varchar)")
    demo_expr = {
        "subjectageyears": f"cast({y} AS varchar)",
        "subjectage": months_txt,
        "gender": "d.sex_cd",
        "dataset": dataset_sql,
        "agegroup": AGE_GROUP.format(y=y),
    }
    sel = [f"d.{k} AS {k}" for k in key_cols] + [f"d.{c} AS {c}" for c in leading]
    for c in cdes:
        if c in DEMOGRAPHICS:
            sel.append(f"coalesce(w.{_q('f_' + c)}, {demo_expr[c]}) AS {_q(c)}")
        else:
            sel.append(f"w.{_q('f_' + c)} AS {_q(c)}")
    for c, kind in locals_:
        if kind == "num":
            sel.append(f"cast(cast(w.{_q('f_' + c)} AS decimal(18,5)) AS double) AS {_q(c)}")
        else:
            sel.append(f"w.{_q('f_' + c)} AS {_q(c)}")
    on = " AND ".join(f"d.{k} = w.{k}" for k in key_cols)
    final = ("SELECT " + ",\n  ".join(sel) + f"\nFROM demo d LEFT JOIN wide w ON {on}")
    return [cells, wide], final


def export_extreme_sql(which: str, anon: str | None = None, cdes=CDES, locals_=LOCALS) -> str:
    agg = "min" if which == "min" else "max"
    ctes = [
        f"""edge AS (SELECT patient_num, {agg}(start_date) AS start_date
                   FROM visit_dimension GROUP BY patient_num)""",
        """sel AS (SELECT v.patient_num, v.encounter_num, v.patient_age
                  FROM visit_dimension v JOIN edge e
                  ON v.patient_num = e.patient_num AND v.start_date = e.start_date)""",
        """sk AS (SELECT pm.patient_ide AS subjectcode, s.patient_num, s.encounter_num, s.patient_age
                 FROM sel s JOIN patient_mapping pm ON pm.patient_num = s.patient_num)""",
        """members AS (SELECT subjectcode, encounter_num, 0 AS role_rank FROM sk)""",
        """demo AS (
          SELECT subjectcode, age, sex_cd FROM (
            SELECT sk.subjectcode, sk.patient_age AS age, pd.sex_cd,
                   row_number() OVER (PARTITION BY sk.subjectcode
                                      ORDER BY sk.encounter_num DESC, sk.patient_num DESC) AS rn
            FROM sk JOIN patient_dimension pd ON pd.patient_num = sk.patient_num) x
          WHERE rn = 1)""",
    ]
    extra, final = _assemble(["subjectcode"], [], integer_months=False, cdes=cdes, locals_=locals_)
    return with_views(*ctes, *extra, select=final, anon=anon)


def export_longitude_sql(anon: str | None = None, cdes=CDES, locals_=LOCALS) -> str:
    ctes = [
        """em AS (SELECT patient_ide AS subjectcode, encounter_ide AS subjectvisitid, encounter_num
                 FROM encounter_mapping)""",
        """members AS (SELECT subjectcode, subjectvisitid, encounter_num, 0 AS role_rank FROM em)""",
        """demo AS (
          SELECT subjectcode, subjectvisitid, subjectvisitdate, age, sex_cd FROM (
            SELECT em.subjectcode, em.subjectvisitid, vd.start_date AS subjectvisitdate,
                   vd.patient_age AS age, pd.sex_cd,
                   row_number() OVER (PARTITION BY em.subjectcode, em.subjectvisitid
                                      ORDER BY em.encounter_num DESC, vd.patient_num DESC) AS rn
            FROM em JOIN visit_dimension vd ON vd.encounter_num = em.encounter_num
                    JOIN patient_dimension pd ON pd.patient_num = vd.patient_num) x
          WHERE rn = 1)""",
    ]
    extra, final = _assemble(["subjectcode", "subjectvisitid"], ["subjectvisitdate"],
                             integer_months=True, cdes=cdes, locals_=locals_)
    return with_views(*ctes, *extra, select=final, anon=anon)


def six_month_ctes(window_seconds: int, pick: str, exclude: tuple[str, ...]) -> list[str]:
    excl = ""
    if exclude:
        excl = " AND tval_char NOT IN (" + ", ".join(f"'{e}'" for e in exclude) + ")"
    order = "abs_dt ASC" if pick == "closest" else "abs_dt DESC"
    return [
        """mri AS (
          SELECT patient_num, mri_date, encounter_num_mri FROM (
            SELECT patient_num, start_date AS mri_date, encounter_num AS encounter_num_mri,
                   row_number() OVER (PARTITION BY patient_num ORDER BY start_date, encounter_num) AS rn
            FROM visit_dimension WHERE location_cd = 'MRI') x WHERE rn = 1)""",
        f"""valid AS (
          SELECT DISTINCT encounter_num FROM observation_fact
          WHERE concept_cd = 'DIAG_etiology_1' AND tval_char IS NOT NULL
            AND tval_char NOT LIKE 'Diagnostic en%'{excl})""",
        f"""cand AS (
          SELECT v.patient_num, v.encounter_num, v.start_date, v.patient_age,
                 m.mri_date, m.encounter_num_mri,
                 abs(epoch(v.start_date) - epoch(m.mri_date)) AS abs_dt
          FROM visit_dimension v JOIN mri m ON v.patient_num = m.patient_num
          WHERE abs(epoch(v.start_date) - epoch(m.mri_date)) <= {window_seconds}
            AND v.encounter_num <> m.encounter_num_mri
            AND v.encounter_num IN (SELECT encounter_num FROM valid))""",
        f"""diag AS (
          SELECT patient_num, mri_date, encounter_num_mri, start_date AS diag_date,
                 encounter_num AS encounter_num_diag, patient_age AS age_diag FROM (
            SELECT *, row_number() OVER (PARTITION BY patient_num
                                         ORDER BY {order}, encounter_num ASC) AS rn
            FROM cand) x WHERE rn = 1)""",
        f"""cog AS (
          SELECT patient_num, concept_cd, encounter_num FROM (
            SELECT d.patient_num, f.concept_cd, f.encounter_num,
                   row_number() OVER (PARTITION BY d.patient_num, f.concept_cd
                     ORDER BY abs(epoch(f.start_date) - epoch(d.diag_date)), f.encounter_num) AS rn
            FROM observation_fact f JOIN diag d ON f.patient_num = d.patient_num
            WHERE f.concept_cd IN ('minimentalstate', 'montrealcognitiveassessment')
              AND abs(epoch(f.start_date) - epoch(d.diag_date)) <= {window_seconds}) x
          WHERE rn = 1)""",
        """tt AS (
          SELECT d.*, mm.encounter_num AS encounter_num_mmse, mo.encounter_num AS encounter_num_moca
          FROM diag d
          LEFT JOIN cog mm ON mm.patient_num = d.patient_num AND mm.concept_cd = 'minimentalstate'
          LEFT JOIN cog mo ON mo.patient_num = d.patient_num
                          AND mo.concept_cd = 'montrealcognitiveassessment')""",
    ]


def export_six_months_sql(window_seconds: int, pick: str, exclude: tuple[str, ...],
                          dataset_sql: str | None = None, anon: str | None = None, cdes=CDES, locals_=LOCALS) -> str:
    ctes = six_month_ctes(window_seconds, pick, exclude) + [
        """stacked AS (
          SELECT patient_num, encounter_num, min(role_rank) AS role_rank FROM (
            SELECT patient_num, encounter_num_mri AS encounter_num, 1 AS role_rank FROM tt
            UNION ALL SELECT patient_num, encounter_num_diag, 2 FROM tt
            UNION ALL SELECT patient_num, encounter_num_mmse, 3 FROM tt
            UNION ALL SELECT patient_num, encounter_num_moca, 4 FROM tt) x
          WHERE encounter_num IS NOT NULL GROUP BY patient_num, encounter_num)""",
        """members AS (
          SELECT pm.patient_ide AS subjectcode, s.encounter_num, s.role_rank
          FROM stacked s JOIN patient_mapping pm ON pm.patient_num = s.patient_num)""",
        """demo AS (
          SELECT subjectcode, age, sex_cd FROM (
            SELECT pm.patient_ide AS subjectcode, tt.age_diag AS age, pd.sex_cd,
                   row_number() OVER (PARTITION BY pm.patient_ide
                                      ORDER BY tt.encounter_num_diag DESC, tt.patient_num DESC) AS rn
            FROM tt JOIN patient_mapping pm ON pm.patient_num = tt.patient_num
                    JOIN patient_dimension pd ON pd.patient_num = tt.patient_num) x
          WHERE rn = 1)""",
    ]
    kw = {"dataset_sql": dataset_sql} if dataset_sql else {}
    extra, final = _assemble(["subjectcode"], [], integer_months=False, prefer_nonempty=True,
                             cdes=cdes, locals_=locals_, **kw)
    return with_views(*ctes, *extra, select=final, anon=anon)



# ------------------------------------------------------- operator oracles --

def _wrap(sql: str, select: str) -> str:
    """``select`` over the result of ``sql`` (a full WITH … SELECT) as ``t``."""
    return select.replace("{t}", f"({sql}) t")


def hashed_ids(sql: str, *ids: str) -> str:
    """An export with its id columns hashed in the result."""
    return _wrap(sql, "SELECT " + ", ".join(f"md5({c}) AS {c}" for c in ids) + f", * EXCLUDE ({', '.join(ids)}) FROM {{t}}")


# Measure concepts of the wide mart, sorted as text like all local concepts.
WIDE = tuple(sorted([*LOCALS, *((f"vol_{i}", "num") for i in range(140))]))
WIDE_FACTS = f"""
  UNION ALL
  SELECT o_orderkey, o_custkey, concat('vol_', cast(l_partkey % 140 AS varchar)), o_orderdate, l_linenumber, 'N', 'E',
         cast(l_extendedprice AS decimal(18,5))
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
observation_fact AS ("""


def wide(sql: str) -> str:
    """An export over the mart with the measure facts."""
    return sql.replace("),\nobservation_fact AS (", WIDE_FACTS, 1)


MINDATE = export_extreme_sql("min")
MAXDATE = export_extreme_sql("max")
TEXT_COLS = CDES + ("priority",)
PROFILE = ("SELECT count(*) AS n_rows, count(DISTINCT subjectcode) AS digests, 1 AS well_formed, "
           "count(DISTINCT subjectcode) AS keys FROM {t}")

EDGE = """edge AS (SELECT patient_num, {agg}(start_date) AS start_date
                  FROM visit_dimension GROUP BY patient_num)"""


def _visits_at(which: str) -> str:
    return with_views(EDGE.format(agg=which), select="""
      SELECT v.patient_num, pm.patient_ide, v.encounter_num, v.start_date,
             cast(v.patient_age AS double) AS patient_age
      FROM visit_dimension v JOIN edge e
        ON v.patient_num = e.patient_num AND v.start_date = e.start_date
      JOIN patient_mapping pm ON pm.patient_num = v.patient_num""")


SIX = six_month_ctes(180 * 86400, "closest", ("NA",))

IMAGING = [
    f"""mri_visits AS (
      SELECT concat('P', cast(o_custkey AS varchar)) AS PATIENT_ID,
             concat('V', cast(o_orderkey AS varchar)) AS VISIT_ID,
             strftime(o_orderdate, '%d/%m/%Y') AS VISIT_DATE,
             cast((4000 + (o_custkey % 55) * 100 + (o_orderkey % 100)) / 100.0 AS decimal(18,5)) AS PATIENT_AGE
      FROM orders)""",
    """volumes AS (
      SELECT concat('P', cast(o_custkey AS varchar), '_V', cast(o_orderkey AS varchar)) AS subjectcode,
             cast(l_quantity AS decimal(18,5)) AS l_quantity,
             cast(l_extendedprice AS decimal(18,5)) AS l_extendedprice,
             cast(l_discount AS decimal(18,5)) AS l_discount,
             cast(l_tax AS decimal(18,5)) AS l_tax
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    """volumes_df AS (
      SELECT split_part(subjectcode, '_', 1) AS PATIENT_ID, split_part(subjectcode, '_', 2) AS VISIT_ID,
             * FROM volumes)""",
    """uv AS (
      SELECT PATIENT_ID, VISIT_ID, Attribute, Value FROM (
        SELECT PATIENT_ID, VISIT_ID, l_quantity, l_extendedprice, l_discount, l_tax FROM volumes_df)
      UNPIVOT INCLUDE NULLS (Value FOR Attribute IN (l_quantity, l_extendedprice, l_discount, l_tax)))""",
    f"""ing_pm AS (
      SELECT *, row_number() OVER (ORDER BY patient_ide, patient_ide_source, project_id) AS patient_num
      FROM (SELECT DISTINCT PATIENT_ID AS patient_ide, '{HOSPITAL}' AS patient_ide_source,
                            '{HOSPITAL}' AS project_id FROM mri_visits) k)""",
    f"""ing_em AS (
      SELECT *, row_number() OVER (ORDER BY encounter_ide, encounter_ide_source, project_id,
                                            patient_ide, patient_ide_source) AS encounter_num
      FROM (SELECT DISTINCT VISIT_ID AS encounter_ide, '{HOSPITAL}' AS encounter_ide_source,
                            '{HOSPITAL}' AS project_id, PATIENT_ID AS patient_ide,
                            '{HOSPITAL}' AS patient_ide_source FROM mri_visits) k)""",
]
LOAD_TIME = "TIMESTAMP '2020-01-01 00:00:00'"
PARSE_DATE = "cast(strptime({c}, '%d/%m/%Y') AS timestamp)"

OBS_IMAGING = f"""of_rows AS (
      SELECT em1.encounter_num, pm2.patient_num, uv.Attribute AS concept_cd,
             em1.project_id AS provider_id, {PARSE_DATE.format(c='mv1.VISIT_DATE')} AS start_date,
             '@' AS modifier_cd, 1 AS instance_num, 'N' AS valtype_cd, 'E' AS tval_char,
             cast(uv.Value AS decimal(18,5)) AS nval_num, 'MRI' AS location_cd,
             {LOAD_TIME} AS import_date
      FROM uv JOIN mri_visits mv1 ON uv.VISIT_ID = mv1.VISIT_ID
              JOIN ing_em em1 ON uv.VISIT_ID = em1.encounter_ide
              JOIN ing_pm pm2 ON em1.patient_ide = pm2.patient_ide)"""

TWO_LOADS = [
    f"""pk_all AS (SELECT DISTINCT PATIENT_ID AS patient_ide, '{HOSPITAL}' AS patient_ide_source,
                                 '{HOSPITAL}' AS project_id FROM mri_visits)""",
    f"""pk1 AS (SELECT DISTINCT PATIENT_ID AS patient_ide, '{HOSPITAL}' AS patient_ide_source,
                              '{HOSPITAL}' AS project_id FROM mri_visits
              WHERE {PARSE_DATE.format(c='VISIT_DATE')} < TIMESTAMP '1998-01-01 00:00:00')""",
    """m1 AS (SELECT *, row_number() OVER (ORDER BY patient_ide, patient_ide_source, project_id)
                    AS patient_num FROM pk1)""",
    """fresh AS (SELECT a.* FROM pk_all a WHERE NOT EXISTS (
                   SELECT 1 FROM m1 WHERE m1.patient_ide = a.patient_ide
                     AND m1.patient_ide_source = a.patient_ide_source
                     AND m1.project_id = a.project_id))""",
    """m2 AS (SELECT *, (SELECT coalesce(max(patient_num), 0) FROM m1)
                    + row_number() OVER (ORDER BY patient_ide, patient_ide_source, project_id)
                    AS patient_num FROM fresh)""",
]

FACT_COLS = ("encounter_num, patient_num, concept_cd, provider_id, start_date, modifier_cd, "
             "instance_num, valtype_cd, tval_char, cast(nval_num AS double) AS nval_num")


def _counters_sql() -> str:
    body = MINDATE[len("WITH "):]
    ctes_part, final = body.rsplit("\nSELECT ", 1)
    return ("WITH " + ctes_part + ",\nflat AS (SELECT " + final + "),\n"
            + f"""allcells AS (SELECT count(*) AS n FROM observation_fact f
                 JOIN members m ON f.encounter_num = m.encounter_num WHERE {WRITABLE})
            SELECT 'cde_columns' AS counter, cast({len(CDES)} AS bigint) AS value
            UNION ALL SELECT 'inserts', count(*) FROM flat
            UNION ALL SELECT 'updates', n FROM allcells""")


def _pivot_observations_sql() -> str:
    concepts = sorted(list(CDES[5:]) + [c for c, _ in LOCALS])
    cols = ",\n  ".join(f"max(CASE WHEN concept_cd = '{c}' THEN v END) AS {_q(c)}" for c in concepts)
    return with_views(f"""cells AS (
      SELECT encounter_num, concept_cd, v FROM (
        SELECT f.encounter_num, f.concept_cd, {TYPED_VALUE} AS v,
               row_number() OVER (PARTITION BY f.encounter_num, f.concept_cd ORDER BY
                 f.instance_num DESC NULLS LAST,
                 CASE WHEN f.valtype_cd = 'N' THEN f.nval_num END DESC NULLS LAST,
                 {TYPED_VALUE} DESC NULLS LAST) AS rn
        FROM observation_fact f WHERE {WRITABLE}) x WHERE rn = 1)""",
                      select=f"SELECT encounter_num,\n  {cols}\nFROM cells GROUP BY encounter_num")


ORACLES: dict[str, str] = {
    "export_mindate": MINDATE,
    "export_maxdate": MAXDATE,
    "export_longitude": export_longitude_sql(),
    "export_6months": export_six_months_sql(180 * 86400, "closest", ("NA",)),
    "export_6months_as_coded": export_six_months_sql(180 * 3600 * 4, "farthest", ()),
    "age_parts": with_views(select="""
      SELECT encounter_num, cast(patient_age AS double) AS patient_age,
             cast(floor(patient_age) AS bigint) AS age_years,
             cast(round((patient_age - floor(patient_age)) * 12) AS bigint) AS age_months
      FROM visit_dimension"""),
    "age_group": with_views(select="SELECT encounter_num, "
                            + AGE_GROUP.format(y="cast(floor(patient_age) AS bigint)")
                            + " AS agegroup FROM visit_dimension"),
    "typed_value": with_views(select=f"""
      SELECT f.encounter_num, f.concept_cd, f.instance_num, {TYPED_VALUE} AS value
      FROM observation_fact f WHERE {WRITABLE}"""),
    "cde_columns": with_views(select="""
      SELECT c.concept_cd, c.upload_id, coalesce(n.n_facts, 0) AS n_facts
      FROM concept_dimension c
      LEFT JOIN (SELECT concept_cd, count(*) AS n_facts FROM observation_fact GROUP BY concept_cd) n
        ON n.concept_cd = c.concept_cd
      WHERE c.sourcesystem_cd = 'CDE'"""),
    "cde_dictionary": """SELECT p_name AS concept_cd, cast(1000000 - p_partkey AS integer) AS upload_id
      FROM part WHERE p_partkey % 3 = 0""",
    "concept_catalog_mixed": with_views(select="""
      SELECT concept_cd, min(vt) AS valtype_cd, min(vt) <> max(vt) AS mixed_valtype, count(*) AS n_facts,
             min(provider_id) AS provider_id
      FROM (SELECT *, CASE WHEN encounter_num % 5 = 0 AND concept_cd IN ('priority', 'quantity') THEN 'T' ELSE valtype_cd END AS vt
            FROM observation_fact) GROUP BY concept_cd"""),
    "sha224_profile": _wrap(MINDATE, PROFILE),
    "sha3_profile": _wrap(MINDATE, PROFILE),
    "concept_catalog": with_views(select="""
      SELECT concept_cd, min(valtype_cd) AS valtype_cd,
             min(valtype_cd) <> max(valtype_cd) AS mixed_valtype,
             count(*) AS n_facts, min(provider_id) AS provider_id
      FROM observation_fact GROUP BY concept_cd"""),
    "dataset_constant": with_views(select="""
      SELECT concept_cd, min(p) AS dataset, count(DISTINCT p) AS providers FROM (
        SELECT concept_cd, CASE WHEN encounter_num % 7 > 0 THEN provider_id || '_' || (7 - encounter_num % 7) END AS p
        FROM observation_fact) GROUP BY concept_cd"""),
    "first_visits": _visits_at("min"),
    "last_visits": _visits_at("max"),
    "first_mri": with_views(SIX[0], select="SELECT * FROM mri"),
    "valid_diagnosis": with_views(SIX[1], select="""
      SELECT encounter_num, patient_num, start_date FROM visit_dimension
      WHERE encounter_num IN (SELECT encounter_num FROM valid)"""),
    "mri_diag_candidates": with_views(*SIX[:3], select="""
      SELECT patient_num, encounter_num, encounter_num_mri, cast(abs_dt AS bigint) AS abs_dt
      FROM cand"""),
    "mri_nearest_diag": with_views(*SIX[:4], select="""
      SELECT patient_num, mri_date, encounter_num_mri, diag_date, encounter_num_diag,
             cast(age_diag AS double) AS age_diag FROM diag"""),
    "diag_cognitive_visits": with_views(*SIX, select="""
      SELECT patient_num, mri_date, encounter_num_mri, diag_date, encounter_num_diag,
             cast(age_diag AS double) AS age_diag, encounter_num_mmse, encounter_num_moca FROM tt"""),
    "pivot_observations": _pivot_observations_sql(),
    "unpivot_measures": with_views(select="""
      SELECT l_orderkey, l_linenumber, Attribute, Value FROM (
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
      UNPIVOT INCLUDE NULLS (Value FOR Attribute IN (l_quantity, l_extendedprice, l_discount, l_tax))"""),
    "unpivot_many": with_views(select="""
      SELECT l_orderkey AS entity_id, l_linenumber AS line_no, Attribute, Value FROM (
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
      UNPIVOT INCLUDE NULLS (Value FOR Attribute IN (l_quantity, l_extendedprice, l_discount, l_tax))
      UNION ALL
      SELECT o_orderkey, cast(NULL AS integer), 'o_totalprice', o_totalprice FROM orders"""),
    "split_subjectcode": with_views(*IMAGING[:3], select="""
      SELECT PATIENT_ID, VISIT_ID, subjectcode, cast(l_quantity AS double) AS l_quantity,
             cast(l_extendedprice AS double) AS l_extendedprice, cast(l_discount AS double) AS l_discount,
             cast(l_tax AS double) AS l_tax FROM volumes_df"""),
    "assign_patient_num": with_views(IMAGING[0], *TWO_LOADS,
                                     select="SELECT * FROM m1 UNION ALL SELECT * FROM m2"),
    "new_patient_ids": with_views(IMAGING[0], *TWO_LOADS, select="SELECT * FROM m2"),
    "assign_encounter_num": with_views(IMAGING[0], IMAGING[5], select="SELECT * FROM ing_em"),
    "map_encounter_mapping": with_views(*IMAGING, select=f"""
      SELECT DISTINCT encounter_ide, encounter_ide_source, project_id, patient_ide, patient_ide_source,
             encounter_num, {LOAD_TIME} AS import_date FROM ing_em"""),
    "map_visit_dimension": with_views(*IMAGING, select=f"""
      SELECT DISTINCT em.encounter_num, pm.patient_num,
             {PARSE_DATE.format(c='mv.VISIT_DATE')} AS start_date,
             cast(mv.PATIENT_AGE AS double) AS patient_age, 'MRI' AS location_cd,
             {LOAD_TIME} AS import_date
      FROM ing_em em JOIN mri_visits mv ON em.encounter_ide = mv.VISIT_ID
                     JOIN ing_pm pm ON em.patient_ide = pm.patient_ide"""),
    "map_patient_mapping": with_views(*IMAGING, select=f"""
      SELECT DISTINCT patient_ide, patient_ide_source, project_id, patient_num,
             {LOAD_TIME} AS import_date FROM ing_pm"""),
    "map_observation_fact": with_views(*IMAGING, OBS_IMAGING, select="""
      SELECT encounter_num, patient_num, concept_cd, provider_id, start_date, modifier_cd,
             instance_num, valtype_cd, tval_char, cast(nval_num AS double) AS nval_num,
             row_number() OVER (ORDER BY encounter_num NULLS FIRST, concept_cd NULLS FIRST,
                                         nval_num NULLS FIRST, patient_num NULLS FIRST)
               AS text_search_index,
             location_cd, import_date
      FROM of_rows"""),
    "anonymize_flat_md5": _wrap(MINDATE, "SELECT md5(subjectcode) AS subjectcode, "
                                         "* EXCLUDE (subjectcode) FROM {t}"),
    "anonymize_mart_md5": with_views(select=f"SELECT {FACT_COLS} FROM observation_fact",
                                     anon="md5"),
    "export_mindate_anon": hashed_ids(MINDATE, "subjectcode"),
    "add_dataset_column": _wrap(_visits_at("min"), f"SELECT *, '{HOSPITAL}' AS Dataset FROM {{t}}"),
    "csv_roundtrip": _wrap(MINDATE, "SELECT " + ", ".join(
        [f"nullif({_q(c)}, '') AS {_q(c)}" for c in ("subjectcode",) + TEXT_COLS]
        + ["quantity", "totalprice"]) + " FROM {t}"),
    "merge_volumes": with_views(*IMAGING[:2], select="""
      SELECT subjectcode, cast(l_quantity AS double) AS l_quantity,
             CASE WHEN cast(split_part(subjectcode, '_V', 2) AS bigint) % 2 = 0 THEN cast(l_extendedprice AS double) END AS l_extendedprice,
             cast(l_discount AS double) AS l_discount, cast(l_tax AS double) AS l_tax FROM volumes"""),
    "map_second_load_patients": with_views(IMAGING[0], *TWO_LOADS, select=f"""
      SELECT *, {LOAD_TIME} AS import_date FROM (SELECT * FROM m1 UNION ALL SELECT * FROM m2)"""),
    "map_second_load_encounters": with_views(IMAGING[0], f"""
      k AS (SELECT DISTINCT VISIT_ID AS encounter_ide, '{HOSPITAL}' AS encounter_ide_source, '{HOSPITAL}' AS project_id,
                   PATIENT_ID AS patient_ide, '{HOSPITAL}' AS patient_ide_source,
                   {PARSE_DATE.format(c='VISIT_DATE')} < TIMESTAMP '1998-01-01 00:00:00' AS early FROM mri_visits)""", select=f"""
      SELECT encounter_ide, encounter_ide_source, project_id, patient_ide, patient_ide_source,
             row_number() OVER (ORDER BY early DESC, encounter_ide, patient_ide) AS encounter_num, {LOAD_TIME} AS import_date
      FROM k"""),
    "ingest_rejects": with_views(*IMAGING[:3], select="""
      SELECT NULL AS PATIENT_ID, VISIT_ID, 'visit without a key' AS reason FROM mri_visits
      WHERE cast(substr(VISIT_ID, 2) AS bigint) % 10 = 0
      UNION ALL SELECT PATIENT_ID, VISIT_ID, 'scan without a visit' FROM volumes_df
      WHERE cast(substr(VISIT_ID, 2) AS bigint) % 10 = 0"""),
    "harmonize_visits": with_views(select="""
      SELECT v.encounter_num, pm.patient_num, v.start_date, cast(v.patient_age AS double) AS patient_age, 'HARMONIZED' AS location_cd
      FROM visit_dimension v JOIN encounter_mapping em ON em.encounter_num = v.encounter_num
      JOIN patient_mapping pm ON pm.patient_ide = em.patient_ide WHERE v.location_cd = 'MRI'"""),
    "extract_csv_readback": _wrap(MAXDATE, "SELECT subjectcode, agegroup, nullif(priority, '') AS priority, totalprice, "
                                           "'CLM' AS \"Dataset\" FROM {t}"),
    "text_roundtrip": """SELECT doc_id, length('  "' || text || '", x' || chr(10) || '  ')::INTEGER AS n_chars,
      md5('  "' || text || '", x' || chr(10) || '  ') AS digest FROM documents""",
    "text_roundtrip_single": """SELECT doc_id, length('  "' || text || '", x' || chr(10) || '  ')::INTEGER AS n_chars,
      md5('  "' || text || '", x' || chr(10) || '  ') AS digest FROM documents""",
    "append_export": MINDATE,
    "export_counters": _counters_sql(),
    "key_violations": with_views(select="""
      SELECT encounter_num, concept_cd, provider_id, instance_num, start_date, modifier_cd,
             count(*) AS n_rows FROM observation_fact
      GROUP BY encounter_num, concept_cd, provider_id, instance_num, start_date, modifier_cd
      HAVING count(*) > 1"""),
    "null_demographics": with_views(EDGE.format(agg="min"), select="""
      SELECT DISTINCT pm.patient_ide AS subjectcode, cast(v.patient_age AS double) AS age,
             CASE WHEN pd.patient_num % 9 > 0 THEN pd.sex_cd END AS sex_cd
      FROM visit_dimension v JOIN edge e ON v.patient_num = e.patient_num AND v.start_date = e.start_date
      JOIN patient_mapping pm ON pm.patient_num = v.patient_num JOIN patient_dimension pd ON pd.patient_num = v.patient_num
      WHERE v.patient_age IS NULL OR pd.patient_num % 9 = 0 OR pd.sex_cd IS NULL"""),
    "bad_valtype": with_views(select=f"""
      SELECT {FACT_COLS.replace('valtype_cd', 'vt AS valtype_cd')} FROM (
        SELECT *, CASE WHEN concept_cd = 'quantity' AND encounter_num % 13 = 0 THEN 'D'
                       WHEN NOT (concept_cd = 'quantity' AND encounter_num % 17 = 0) THEN valtype_cd END AS vt
        FROM observation_fact)
      WHERE vt NOT IN ('N', 'T') OR vt IS NULL"""),
    "batch_scan": with_views(IMAGING[0], select="""
      SELECT PATIENT_ID, VISIT_ID, VISIT_DATE, cast(PATIENT_AGE AS double) AS PATIENT_AGE, 'batch_1' AS batch FROM mri_visits"""),
    "append_export_merged": _wrap(MINDATE, "SELECT * FROM {t}") + " UNION ALL BY NAME " + _wrap(
        MAXDATE, "SELECT " + ", ".join(f"nullif({_q(c)}, '') AS {_q(c)}" for c in TEXT_COLS)
        + ", quantity, totalprice, 'old-' || subjectcode AS subjectcode FROM {t}"),
}


LOCAL_LAYOUT = {"cdes": DEMOGRAPHICS,
                "locals_": tuple((m, "num") for m in ("l_discount", "l_extendedprice", "l_quantity", "l_tax"))}


def _local_sql(core: str, more_facts: str = "") -> str:
    """An export over the capture mart built by the imaging ingest (cap_* views)."""
    import re
    body = core[len("WITH "):]
    body = body[len(VIEWS.strip()) + 2:]   # drop the clinical views; keep the export CTEs
    for t in STAR:
        body = re.sub(rf"\b{t}\b", f"cap_{t}", body)
    cap = [
        f"""cap_observation_fact AS (
          SELECT encounter_num, patient_num, concept_cd, provider_id, start_date, modifier_cd,
                 instance_num, valtype_cd, tval_char, nval_num FROM of_rows{more_facts})""",
        """cap_visit_dimension AS (
          SELECT DISTINCT em.encounter_num, pm.patient_num,
                 cast(strptime(mv.VISIT_DATE, '%d/%m/%Y') AS timestamp) AS start_date,
                 cast(mv.PATIENT_AGE AS decimal(18,5)) AS patient_age, 'MRI' AS location_cd
          FROM ing_em em JOIN mri_visits mv ON em.encounter_ide = mv.VISIT_ID
                         JOIN ing_pm pm ON em.patient_ide = pm.patient_ide)""",
        """cap_encounter_mapping AS (SELECT DISTINCT encounter_ide, patient_ide, encounter_num FROM ing_em)""",
        """cap_patient_mapping AS (SELECT DISTINCT patient_ide, patient_ide_source, project_id,
                                         patient_num FROM ing_pm)""",
        """cap_patient_dimension AS (
          SELECT pm.patient_num, CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex_cd
          FROM ing_pm pm JOIN customer c ON pm.patient_ide = concat('P', cast(c.c_custkey AS varchar)))""",
    ]
    head = with_views(*IMAGING, OBS_IMAGING, *cap, select="")
    return head.rstrip() + ",\n" + body


ORACLES.update({
    "export_local_mindate": _local_sql(export_extreme_sql("min", **LOCAL_LAYOUT)),
    "export_local_maxdate": _local_sql(export_extreme_sql("max", **LOCAL_LAYOUT)),
    "export_local_longitude": _local_sql(export_longitude_sql(**LOCAL_LAYOUT)),
    "export_maxdate_anon": hashed_ids(MAXDATE, "subjectcode"),
    "export_longitude_anon": hashed_ids(export_longitude_sql(), "subjectcode", "subjectvisitid"),
    "export_6months_anon": hashed_ids(export_six_months_sql(180 * 86400, "closest", ("NA",), dataset_sql="'CLM'"), "subjectcode"),
    "export_mindate_wide": wide(export_extreme_sql("min", locals_=WIDE)),
    "export_longitude_wide": wide(export_longitude_sql(locals_=WIDE)),
})

# ------------------------------------------------------------ stored marts --
# The span of a visit's day is its load; numbers go on from load to load, in key order within one.
SPAN = "CASE WHEN o_orderdate < TIMESTAMP '1997-01-01 00:00:00' THEN 1 WHEN o_orderdate < TIMESTAMP '1999-01-01 00:00:00' THEN 2 ELSE 3 END"
LOADED = [
    f"""visits AS (SELECT concat('P', cast(o_custkey AS varchar)) AS patient_ide, concat('V', cast(o_orderkey AS varchar)) AS encounter_ide,
                          {SPAN} AS load, o_orderdate AS start_date, o_orderkey,
                          cast((4000 + (o_custkey % 55) * 100 + (o_orderkey % 100)) / 100.0 AS double) AS patient_age FROM orders)""",
    "patients AS (SELECT patient_ide, row_number() OVER (ORDER BY min(load), patient_ide) AS patient_num FROM visits GROUP BY patient_ide)",
    "numbered AS (SELECT *, row_number() OVER (ORDER BY load, encounter_ide) AS encounter_num FROM visits JOIN patients USING (patient_ide))",
    """scans AS (SELECT l_orderkey, unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS concept_cd,
                        unnest([cast(l_quantity AS decimal(18,5)), cast(l_extendedprice AS decimal(18,5)), cast(l_discount AS decimal(18,5)),
                                cast(l_tax AS decimal(18,5))]) AS nval_num FROM lineitem)""",
]


def _loaded(select: str) -> str:
    return "WITH " + ",\n".join(LOADED) + "\n" + select


def _edge_visits(agg: str) -> str:
    return _loaded(f"""SELECT patient_ide, encounter_ide, start_date, patient_age FROM visits
      QUALIFY start_date = {agg}(start_date) OVER (PARTITION BY patient_ide)""")


LATE_FACTS = """
  UNION ALL
  SELECT o_orderkey, o_custkey, 'latecomer', o_orderdate, 1, 'N', 'E', cast(o_orderkey % 97 AS decimal(18,5)) FROM orders),
observation_fact AS ("""

ORACLES.update({
    "loads_patients": _loaded(f"SELECT patient_ide, '{HOSPITAL}' AS patient_ide_source, '{HOSPITAL}' AS project_id, patient_num FROM patients"),
    "loads_visits": _loaded("SELECT encounter_num, encounter_ide, patient_num, start_date, patient_age, 'MRI' AS location_cd FROM numbered"),
    "loads_facts": _loaded(f"""SELECT encounter_num, patient_num, concept_cd, '{HOSPITAL}' AS provider_id, start_date, '@' AS modifier_cd,
      1 AS instance_num, 'N' AS valtype_cd, 'E' AS tval_char, cast(nval_num AS double) AS nval_num,
      row_number() OVER (ORDER BY load, encounter_num, concept_cd, nval_num NULLS FIRST) AS text_search_index, 'MRI' AS location_cd
      FROM scans JOIN numbered ON l_orderkey = o_orderkey"""),
    "stored_first_visits": _edge_visits("min"),
    "stored_last_visits": _edge_visits("max"),
    "stored_export_mindate": _local_sql(export_extreme_sql("min", **LOCAL_LAYOUT)),
    "stored_export_maxdate": _local_sql(export_extreme_sql("max", **LOCAL_LAYOUT)),
    "ledger_offers": """SELECT k AS offer, status, n_files, (SELECT count(*) FROM orders) AS n_visits
      FROM (VALUES (1, 'new', 5), (2, 'loaded', 5), (3, 'loaded', 4), (3, 'changed', 1)) t(k, status, n_files)""",
    "stale_catalog_mindate": export_extreme_sql("min", locals_=tuple(sorted([*LOCALS, ("latecomer", "num")]))).replace(
        "),\nobservation_fact AS (", LATE_FACTS, 1),
})
_JOB = "SELECT {code} AS subjectcode, agegroup, nullif(priority, '') AS priority, totalprice, '{dataset}' AS \"Dataset\" FROM {{t}}"
ORACLES["job_append_skipped"] = _wrap(MAXDATE, _JOB.format(code="subjectcode", dataset="CLM"))
ORACLES["job_append_merged"] = (f"SELECT * FROM ({ORACLES['job_append_skipped']}) UNION ALL "
                                f"SELECT * FROM ({_wrap(MINDATE, _JOB.format(code='md5(subjectcode)', dataset='OLD'))})")
ORACLES["text_roundtrip_split"] = ORACLES["text_roundtrip"]
ORACLES["merge_volumes_mixed"] = with_views(*IMAGING[:2], select="""
  SELECT subjectcode, cast(l_quantity AS double) AS l_quantity, CASE WHEN k % 3 = 0 THEN concat('run', k) ELSE cast(k AS varchar) END AS run,
         cast(l_tax AS double) AS l_tax FROM (SELECT *, cast(split_part(subjectcode, '_V', 2) AS bigint) % 24 AS k FROM volumes)""")

_TESTS = ("DIAG_etiology_1", "minimentalstate", "montrealcognitiveassessment")
ORACLES["export_local_6months"] = _local_sql(
    export_six_months_sql(180 * 86400, "closest", ("NA",), cdes=DEMOGRAPHICS, locals_=tuple(sorted(
        [*LOCAL_LAYOUT["locals_"], (_TESTS[0], "text"), (_TESTS[1], "num"), (_TESTS[2], "num")]))),
    f"""
          UNION ALL
          SELECT em.encounter_num, pm.patient_num, f.concept_cd, '{HOSPITAL}', f.start_date, '@', f.instance_num, f.valtype_cd, f.tval_char, f.nval_num
          FROM order_facts f JOIN ing_em em ON em.encounter_ide = concat('V', cast(f.encounter_num AS varchar))
                             JOIN ing_pm pm ON pm.patient_ide = em.patient_ide
          WHERE f.concept_cd IN {_TESTS}""")
ORACLES["export_outcomes"] = with_views(EDGE.format(agg="min"), """
  picked AS (SELECT v.patient_num, v.encounter_num FROM visit_dimension v JOIN edge e
             ON v.patient_num = e.patient_num AND v.start_date = e.start_date)""", """
  facts AS (SELECT p.patient_num, f.*, f.concept_cd = 'quantity' AND f.encounter_num % 13 = 0 AS bad
            FROM picked p JOIN observation_fact f ON f.encounter_num = p.encounter_num)""", """
  best AS (SELECT patient_num, nval_num FROM facts WHERE concept_cd = 'quantity' AND NOT bad QUALIFY row_number() OVER
             (PARTITION BY patient_num ORDER BY encounter_num DESC, instance_num DESC, nval_num DESC) = 1)""", """
  n AS (SELECT count(*) FILTER (bad) AS skipped_facts,
               count(*) FILTER (NOT bad AND (valtype_cd = 'T' OR nval_num IS NOT NULL)) AS updates FROM facts)""", select="""
  SELECT pm.patient_ide AS subjectcode, cast(cast(b.nval_num AS decimal(18,5)) AS varchar) AS quantity,
         CASE WHEN pm.patient_num % 9 = 0 THEN 'NULL age, gender or dataset' ELSE 'accepted' END AS outcome,
         count(*) FILTER (pm.patient_num % 9 <> 0) OVER () AS inserts, count(*) FILTER (pm.patient_num % 9 = 0) OVER () AS rejected_subjects,
         n.updates, n.skipped_facts
  FROM (SELECT DISTINCT patient_num FROM picked) k JOIN patient_mapping pm USING (patient_num) LEFT JOIN best b USING (patient_num), n""")
