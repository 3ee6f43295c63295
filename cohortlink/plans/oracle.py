"""DuckDB oracle SQL for every registered query (same column names and types)."""

from __future__ import annotations

from ..config import SUBJECT_CODES
from .roles import STUDY_SCALE_CODES, STUDY_TEST_NAMES

_TESTS = ", ".join(f"'{t}'" for t in STUDY_TEST_NAMES)
_SCALES = ", ".join(str(s) for s in STUDY_SCALE_CODES)

EVENT_VIEW = """
ev AS (
  SELECT r.r_name AS DISTRICT_GEOGRAPHY_NAME,
         CAST(year(o.o_orderdate) AS INTEGER) AS TERM_NUMBER,
         'SPRING ' || CAST(year(o.o_orderdate) AS VARCHAR) AS TERM_NAME,
         p.p_type AS SUBJECT,
         CAST(l.l_linenumber + 5 AS INTEGER) AS MEASUREMENT_SCALE_BID,
         p.p_brand AS TEST_NAME,
         CAST(p.p_size AS INTEGER) AS GRADE_ORDINAL,
         n.n_name AS DISTRICT_STANDARD_NAME,
         lpad(CAST(n.n_nationkey AS VARCHAR), 4, '0') AS DISTRICT_AGENCY_CODE,
         s.s_name AS SCHOOL_STANDARD_NAME,
         c.c_custkey AS STUDENT_BUSINESS_IDENTIFIER,
         l.l_extendedprice AS ASSESS_SCORE,
         l.l_linestatus = 'F' AS GROWTH_EVENT_YN,
         l.l_returnflag <> 'R' AS VALID_EVENT_YN
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

_BASE = "DISTRICT_GEOGRAPHY_NAME, TERM_NAME, SUBJECT, MEASUREMENT_SCALE_BID, TEST_NAME"
_DIST = _BASE + ", DISTRICT_STANDARD_NAME, DISTRICT_AGENCY_CODE"
_COUNTS = ("count(DISTINCT SCHOOL_STANDARD_NAME) AS school_count, "
           "count(DISTINCT STUDENT_BUSINESS_IDENTIFIER) AS student_count")
_FLT1 = f"ASSESS_SCORE IS NOT NULL AND TEST_NAME IN ({_TESTS})"

ORACLE: dict[str, str] = {}

ORACLE["counts_total_by_test"] = f"""
WITH {EVENT_VIEW}
SELECT {_BASE}, count(*) AS test_count
FROM ev
WHERE MEASUREMENT_SCALE_BID IN ({_SCALES}) AND GROWTH_EVENT_YN
GROUP BY {_BASE}
ORDER BY MEASUREMENT_SCALE_BID, test_count DESC"""

ORACLE["counts_by_grade"] = f"""
WITH {EVENT_VIEW}
SELECT {_BASE}, GRADE_ORDINAL AS GRADE, {_COUNTS}
FROM ev WHERE {_FLT1}
GROUP BY {_BASE}, GRADE_ORDINAL
ORDER BY MEASUREMENT_SCALE_BID, TEST_NAME, GRADE"""

ORACLE["counts_by_district"] = f"""
WITH {EVENT_VIEW}
SELECT {_DIST}, {_COUNTS}
FROM ev WHERE {_FLT1}
GROUP BY {_DIST}
ORDER BY MEASUREMENT_SCALE_BID, TEST_NAME, student_count DESC"""

ORACLE["counts_by_district_grade"] = f"""
WITH {EVENT_VIEW}
SELECT {_DIST}, GRADE_ORDINAL AS GRADE, {_COUNTS}
FROM ev WHERE {_FLT1}
GROUP BY {_DIST}, GRADE_ORDINAL
ORDER BY MEASUREMENT_SCALE_BID, TEST_NAME, DISTRICT_STANDARD_NAME, GRADE"""

ORACLE["counts_grouping_sets"] = f"""
WITH {EVENT_VIEW}
SELECT {_DIST}, GRADE_ORDINAL AS GRADE, {_COUNTS},
       CASE WHEN grouping(DISTRICT_STANDARD_NAME) = 1 THEN 'by_grade'
            WHEN grouping(GRADE_ORDINAL) = 1 THEN 'by_district'
            ELSE 'by_district_grade' END AS report
FROM ev WHERE {_FLT1}
GROUP BY GROUPING SETS (({_BASE}, GRADE_ORDINAL), ({_DIST}), ({_DIST}, GRADE_ORDINAL))"""


# ---------------------------------------------------------------------------
# Partner pipeline (wide -> long -> clean -> settings -> flags)
# ---------------------------------------------------------------------------
from ..config import GRADE_VARIANTS, SCORE_SUFFIXES  # noqa: E402
from .roles import (DOB_BASE, PARTNER_SUBJECTS, SETTINGS_ROWS, STUDY_AS_OF,  # noqa: E402
                    TERM_YEAR_SHIFT, TEST_DATE_SHIFT_DAYS, NO_TESTNAME, TEST_DATE_STYLES, LINE_ORDER)

_GMAP = "MAP {" + ", ".join(f"'{v.replace(' ', '').upper()}': {g}"
                            for g, vs in GRADE_VARIANTS.items() for v in vs) + "}"
_AS_OF_YEAR = int(STUDY_AS_OF[:4])


def _dfmt(d: str, style: str) -> str:
    return {"mdY": f"strftime({d}, '%m/%d/%Y')", "mdY_unpadded": f"strftime({d}, '%-m/%-d/%Y')",
            "Ymd": f"strftime({d}, '%Y%m%d')", "mdY_compact": f"strftime({d}, '%m%d%Y')",
            "iso_time": f"(strftime({d}, '%Y-%m-%d') || ' 00:00:00')",
            "mdy": f"strftime({d}, '%m/%d/%y')", "iso": f"strftime({d}, '%Y-%m-%d')",
            "mdy_unpadded": f"strftime({d}, '%-m/%-d/%y')"}[style]


def _nb(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '\\s*') THEN NULL ELSE {x} END"


def _partner_wide_cte() -> str:
    aggs = []
    for ln, s in PARTNER_SUBJECTS:
        on = f"l_linenumber = {ln}"
        aggs += [f"max(CASE WHEN {on} THEN CAST(floor(l_extendedprice) AS BIGINT) END) AS {s}_ss",
                 f"min(CASE WHEN {on} THEN l_discount END) AS {s}_disc",
                 f"min(CASE WHEN {on} THEN CAST(l_shipdate AS DATE) END) AS {s}_ship",
                 f"min(CASE WHEN {on} THEN l_returnflag END) AS {s}_flag"]
    key, cust = "o.o_orderkey", "c.c_custkey"
    cs = f"CAST({cust} AS VARCHAR)"
    yr = f"CAST(year(o.o_orderdate) + {TERM_YEAR_SHIFT} AS INTEGER)"
    ys = f"CAST({yr} AS VARCHAR)"
    dob = f"(DATE '{DOB_BASE}' + CAST({cust} % 7000 AS INTEGER))"
    styles = ["mdY", "mdY_unpadded", "Ymd", "mdY_compact", "iso_time", "mdy"]
    dob_txt = "CASE " + " ".join(f"WHEN {key} % 6 = {i} THEN {_dfmt(dob, st)}" for i, st in enumerate(styles)) + " END"
    g = f"CAST({cust} % 12 + 1 AS VARCHAR)"
    nat3 = "lpad(CAST(c.c_nationkey AS VARCHAR), 3, '0')"
    cols = [
        f"CASE WHEN _nth = 1 THEN CAST({key} AS VARCHAR) ELSE CAST({key} AS VARCHAR) || '/' || CAST(_nth AS VARCHAR) END AS RECORD_ID",
        "'District ' || CAST(c.c_nationkey AS VARCHAR) AS DISTRICTNAME",
        "c.c_mktsegment AS SCHOOLNAME",
        f"CASE {key} % 5 WHEN 0 THEN ' ' || {cs} || ' ' WHEN 1 THEN lpad({cs}, 8, '0') "
        f"WHEN 2 THEN {cs} || '.7' WHEN 3 THEN 'S' || {cs} ELSE {cs} END AS STATE_STID",
        f"CASE {key} % 7 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE CAST({cust} + 100000 AS VARCHAR) END AS LOCAL_STID",
        f"CASE WHEN {key} % 3 = 0 THEN upper(c.c_name) ELSE c.c_name END AS LNAME", "c.c_mktsegment AS FNAME",
        f"{dob_txt} AS DOB",
        f"CASE {key} % 8 WHEN 0 THEN {g} WHEN 1 THEN lpad({g}, 2, '0') WHEN 2 THEN {g} || '.0' "
        f"WHEN 3 THEN 'Grade ' || {g} WHEN 4 THEN 'GRADE ' || lpad({g}, 2, '0') WHEN 5 THEN 'K' "
        f"WHEN 6 THEN 'KG' ELSE ' ' END AS GRADE",
        f"CASE {cust} % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'female' END AS SEX",
        f"CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Spring ' || {ys} WHEN '2-HIGH' THEN 'Fall ' || {ys} "
        f"WHEN '3-MEDIUM' THEN 'SP' || substring({ys}, 3, 2) "
        f"WHEN '4-NOT SPECIFIED' THEN CAST({yr} - 1 AS VARCHAR) || '-' || substring({ys}, 3, 2) END AS TERM",
    ]
    tstyle = TEST_DATE_STYLES
    for _, s in PARTNER_SUBJECTS:
        cols.append(f"CASE WHEN {s}_disc = 0 THEN ' ' WHEN {s}_disc = 0.01 THEN CAST({s}_ss AS VARCHAR) || 'x' "
                    f"ELSE CAST({s}_ss AS VARCHAR) END AS {s}_SS")
        cols.append(f"{s}_flag AS {s}_PLCODE")
        if s not in NO_TESTNAME:
            cols.append(f"'{s.title()} ' || {s}_flag AS {s}_TESTNAME")
        cols.append(f"{_dfmt(f'({s}_ship + {TEST_DATE_SHIFT_DAYS})', tstyle[s])} AS {s}_TESTDATE")
    cols += [f"'district_' || {nat3} || '.csv' AS FILENAMEFROMDISTRICT", f"{nat3} AS AGENCYCODE"]
    names = [c.rsplit(" AS ", 1)[1] for c in cols]
    norm = ", ".join(f"{_nb(n)} AS {n}" for n in names)
    return (f"li AS (SELECT l_orderkey, _nth, {', '.join(aggs)} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
            f"ORDER BY {', '.join(LINE_ORDER)}) AS _nth FROM lineitem) GROUP BY l_orderkey, _nth),\n"
            f"wide_raw AS (SELECT {', '.join(cols)} FROM li JOIN orders o ON li.l_orderkey = o.o_orderkey "
            f"JOIN customer c ON o.o_custkey = c.c_custkey),\n"
            f"wide AS (SELECT {norm} FROM wide_raw)"), names


WIDE_CTE, WIDE_COLS = _partner_wide_cte()
_REPEAT = [c for c in WIDE_COLS if not any(c == f"{s}_{x}" for _, s in PARTNER_SUBJECTS for x in SCORE_SUFFIXES)]


def _long_cte() -> str:
    parts = []
    for _, s in sorted(PARTNER_SUBJECTS, key=lambda t: t[1]):
        sel = [f"{c} AS D_{c}" for c in _REPEAT] + [f"'{s}' AS D_SUBJECT"]
        for suf in SCORE_SUFFIXES:
            src = f"{s}_{suf}"
            sel.append(f"{src} AS D_{suf}" if src in WIDE_COLS else f"CAST(NULL AS VARCHAR) AS D_{suf}")
        parts.append("SELECT " + ", ".join(sel) + " FROM wide")
    return "long AS (SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE D_SS IS NOT NULL)"


LONG_CTE = _long_cte()


def sql_clean_grade(x: str) -> str:
    n = f"TRY_CAST(trim({x}) AS DECIMAL(38,10))"
    whole = f"CASE WHEN {n} = floor({n}) THEN TRY_CAST({n} AS INTEGER) END"
    valid = ", ".join(str(g) for g in sorted(GRADE_VARIANTS))
    return (f"CAST(COALESCE(CASE WHEN ({whole}) IN ({valid}) THEN ({whole}) END, "
            f"{_GMAP}[upper(regexp_replace({x}, '\\s+', '', 'g'))]) AS INTEGER)")


def sql_clean_int(x: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST(trim({x}) AS DECIMAL(38,10))) AS BIGINT)"


def _mkdate(y: str, m: str, d: str) -> str:
    return (f"CASE WHEN ({y}) BETWEEN 1 AND 9999 AND ({m}) BETWEEN 1 AND 12 AND ({d}) BETWEEN 1 AND 31 "
            f"THEN CAST(try_strptime(printf('%04d-%02d-%02d', {y}, {m}, {d}), '%Y-%m-%d') AS DATE) END")


def _i(x: str) -> str:
    return f"TRY_CAST(trim({x}) AS INTEGER)"


_M = "(1[0-2]|0[1-9]|[1-9])"
_D = "(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
_LAYOUTS = ((f"^{_M}/{_D}/([0-9]{{4}})$", "mdy", False), (f"^{_M}-{_D}-([0-9]{{4}})$", "mdy", False),
            (f"^([0-9]{{4}})-{_M}-{_D}$", "ymd", False), (f"^([0-9]{{4}})/{_M}/{_D}$", "ymd", False),
            (f"^{_M}/{_D}/([0-9]{{2}})$", "mdy", True), (f"^([0-9]{{4}}){_M}{_D}$", "ymd", False),
            (f"^{_M}{_D}([0-9]{{4}})$", "mdy", False), (f"^{_M}{_D}([0-9]{{2}})$", "mdy", True))


def sql_parse_date(x: str) -> str:
    s = f"regexp_replace(trim({x}), '\\s+[0-9]{{1,2}}:[0-9]{{2}}(:[0-9]{{2}})?$', '')"
    sub = lambda a, b: _i(f"substring({s}, {a}, {b})")
    y6 = sub(5, 2)
    rules = [
        f"CASE WHEN regexp_full_match({s}, '[0-9]{{8}}') THEN COALESCE({_mkdate(sub(5, 4), sub(1, 2), sub(3, 2))}, "
        f"{_mkdate(sub(1, 4), sub(5, 2), sub(7, 2))}) END",
        f"CASE WHEN regexp_full_match({s}, '[0-9]{{7}}') THEN {_mkdate(sub(4, 4), sub(1, 1), sub(2, 2))} END",
        f"CASE WHEN regexp_full_match({s}, '[0-9]{{6}}') THEN "
        f"{_mkdate(f'CASE WHEN {y6} > 30 THEN {y6} + 1900 ELSE {y6} + 2000 END', sub(1, 2), sub(3, 2))} END",
    ]
    for pat, order, two in _LAYOUTS:
        part = {k: _i(f"regexp_extract({s}, '{pat}', {i + 1})") for i, k in enumerate(order)}
        y = part["y"]
        if two:
            y = f"CASE WHEN {y} >= 69 THEN {y} + 1900 ELSE {y} + 2000 END"
        rules.append(f"CASE WHEN regexp_matches({s}, '{pat}') THEN {_mkdate(y, part['m'], part['d'])} END")
    return "COALESCE(" + ", ".join(rules) + ")"


def sql_plausible_dob(d: str) -> str:
    return f"CASE WHEN {_AS_OF_YEAR} - year({d}) BETWEEN 4 AND 25 THEN {d} END"


def sql_date_text(d: str) -> str:
    return f"strftime({d}, '%m/%d/%Y')"


def sql_study_year(t: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract(trim(CAST({t} AS VARCHAR)), '^([0-9]{{4}})', 1), '') AS INTEGER)"


_SEASON = "|".join([r"\bFALL\b", r"\bAUTUMN\b", r"\bFA\b", r"\bF[0-9]{2}\b", r"\bSUMMER\b", r"\bSUM\b",
                    r"\bSU\b", r"\bWINTER\b", r"\bWIN\b", r"\bWI\b", r"\bW[0-9]{2}\b"])


def sql_incorrect_term(term: str, settings_term: str) -> str:
    t = f"upper(trim({term}))"
    y = sql_study_year(settings_term)
    years = (f"list_concat(list_transform(regexp_extract_all({t}, '20[0-9]{{2}}'), lambda x: CAST(x AS INTEGER)), "
             f"list_transform(list_filter(string_split_regex({t}, '[^0-9]+'), "
             f"lambda x: length(x) = 2 AND TRY_CAST(x AS INTEGER) <= 50), lambda x: CAST(x AS INTEGER) + 2000))")
    return (f"CASE WHEN {t} IS NULL OR {y} IS NULL THEN false "
            f"WHEN regexp_matches({t}, '{_SEASON}') THEN true "
            f"WHEN len({years}) > 0 AND NOT (list_contains({years}, {y}) OR list_contains({years}, {y} - 1)) "
            f"THEN true ELSE false END")


def sql_date_out_of_range(d: str, settings_term: str) -> str:
    y = sql_study_year(settings_term)
    return (f"COALESCE(({d} < make_date({y}, 2, 1) OR {d} > make_date({y}, 6, 30)) "
            f"AND year({d}) BETWEEN 1678 AND 2261 AND {y} IS NOT NULL AND {d} IS NOT NULL, false)")


def sql_grade_list(x: str) -> str:
    g = lambda k: f"{_GMAP}[{k}]"
    lo, hi = g("split_part(t, '-', 1)"), g("regexp_extract(t, '^[^-]*-(.*)$', 1)")
    tok = (f"list_filter(string_split_regex(upper(trim(COALESCE(CAST({x} AS VARCHAR), ''))), '[,\\s;]+'), "
           f"lambda t: t <> '')")
    per = (f"lambda t: CASE WHEN contains(t, '-') THEN (CASE WHEN {lo} IS NOT NULL AND {hi} IS NOT NULL AND {lo} <= {hi} "
           f"THEN generate_series(CAST({lo} AS BIGINT), CAST({hi} AS BIGINT)) ELSE CAST([] AS BIGINT[]) END) "
           f"ELSE (CASE WHEN {g('t')} IS NOT NULL THEN [CAST({g('t')} AS BIGINT)] ELSE CAST([] AS BIGINT[]) END) END")
    return f"list_sort(list_distinct(flatten(list_transform({tok}, {per}))))"


def sql_list_text(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN '[' || array_to_string({x}, ', ') || ']' END"


_SETTINGS_VALUES = ", ".join(
    "(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row) + ")" for row in SETTINGS_ROWS)

SETTINGS_CTE = (
    f"settings_raw AS (SELECT * FROM (VALUES {_SETTINGS_VALUES}) "
    f"AS t(D_SUBJECT, VENDOR_TEST_NAME, STUDY_GRADES, TERM, NOTES)),\n"
    f"settings AS (SELECT D_SUBJECT AS SETTINGS_D_SUBJECT, VENDOR_TEST_NAME AS SETTINGS_VENDOR_TEST_NAME, "
    f"trim(STUDY_GRADES) AS SETTINGS_STUDY_GRADES, TERM AS SETTINGS_TERM, NOTES AS SETTINGS_NOTES, "
    f"{sql_grade_list('STUDY_GRADES')} AS SETTINGS_GRADE_LIST FROM settings_raw),\n"
    f"subject_grades AS (SELECT SETTINGS_D_SUBJECT AS _subj, list_sort(list_distinct(flatten(list(SETTINGS_GRADE_LIST)))) "
    f"AS _subject_grades FROM settings GROUP BY SETTINGS_D_SUBJECT)")

CLEAN_CTE = (
    "clean_long AS (SELECT *, "
    f"{sql_clean_grade('D_GRADE')} AS D_GRADE_CLEAN, "
    + ", ".join(f"{sql_clean_int(c)} AS {c}_CLEAN" for c in ("D_LOCAL_STID", "D_STATE_STID", "D_AGENCYCODE", "D_SS"))
    + f", {sql_parse_date('D_TESTDATE')} AS D_TESTDATE_DATE, "
    f"{sql_plausible_dob(sql_parse_date('D_DOB'))} AS D_DOB_DATE FROM long)")

FLAGS_CTE = (
    "joined AS (SELECT c.*, s.*, s.SETTINGS_D_SUBJECT IS NOT NULL AS _in FROM clean_long c "
    "LEFT JOIN settings s ON c.D_SUBJECT = s.SETTINGS_D_SUBJECT),\n"
    "flags AS (SELECT j.*, strftime(D_TESTDATE_DATE, '%m/%d/%Y') AS D_TESTDATE_CLEAN, "
    "strftime(D_DOB_DATE, '%m/%d/%Y') AS D_DOB_CLEAN, CASE WHEN _in THEN NULLIF(concat_ws('|', "
    "CASE WHEN D_GRADE_CLEAN IS NULL THEN 'missing_grade' END, "
    "CASE WHEN D_GRADE_CLEAN IS NOT NULL AND NOT COALESCE(list_contains(g._subject_grades, D_GRADE_CLEAN), false) "
    "THEN 'grade_not_in_study' END, "
    "CASE WHEN D_SS IS NOT NULL AND NOT regexp_full_match(D_SS, '\\s*') AND D_SS_CLEAN IS NULL THEN 'non_numeric_SS' END, "
    f"CASE WHEN {sql_incorrect_term('D_TERM', 'SETTINGS_TERM')} THEN 'incorrect_term' END, "
    f"CASE WHEN {sql_date_out_of_range('D_TESTDATE_DATE', 'SETTINGS_TERM')} THEN 'test_date_out_of_range' END"
    "), '') END AS FLAG_REASON FROM joined j LEFT JOIN subject_grades g ON j.D_SUBJECT = g._subj),\n"
    "split AS (SELECT *, CASE WHEN NOT _in THEN 'dropped_subject' WHEN FLAG_REASON IS NOT NULL THEN 'flagged' "
    "WHEN COALESCE(list_contains(SETTINGS_GRADE_LIST, D_GRADE_CLEAN), false) THEN 'kept' "
    "ELSE 'not_allowed' END AS SPLIT FROM flags)")

PARTNER_CTES = ",\n".join([WIDE_CTE, LONG_CTE, SETTINGS_CTE, CLEAN_CTE, FLAGS_CTE])

_LONG_COLS = [f"D_{c}" for c in _REPEAT] + ["D_SUBJECT"] + [f"D_{s}" for s in SCORE_SUFFIXES]
ORACLE["wide_to_long"] = f"WITH {WIDE_CTE},\n{LONG_CTE}\nSELECT {', '.join(_LONG_COLS)} FROM long"

ORACLE["clean_grade"] = f"""WITH {WIDE_CTE}
SELECT GRADE, {sql_clean_grade('GRADE')} AS GRADE_CLEAN, count(*) AS record_count
FROM wide GROUP BY ALL"""

ORACLE["clean_int"] = f"""WITH {WIDE_CTE}
SELECT RECORD_ID, STATE_STID, {sql_clean_int('STATE_STID')} AS STATE_STID_CLEAN,
       LOCAL_STID, {sql_clean_int('LOCAL_STID')} AS LOCAL_STID_CLEAN,
       {sql_clean_int('AGENCYCODE')} AS AGENCYCODE_CLEAN FROM wide"""

_date_cols = ", ".join(f"{s}_TESTDATE, {sql_date_text(sql_parse_date(f'{s}_TESTDATE'))} AS {s}_TESTDATE_CLEAN"
                       for _, s in PARTNER_SUBJECTS)
ORACLE["clean_date"] = f"""WITH {WIDE_CTE}
SELECT RECORD_ID, DOB, {sql_date_text(sql_plausible_dob(sql_parse_date('DOB')))} AS DOB_CLEAN, {_date_cols}
FROM wide"""

_FLAG_OUT = ("D_RECORD_ID, D_SUBJECT, SETTINGS_VENDOR_TEST_NAME, D_GRADE, D_GRADE_CLEAN, D_SS, D_SS_CLEAN, "
             "D_TERM, D_TESTDATE, D_TESTDATE_CLEAN, D_DOB_CLEAN, D_STATE_STID_CLEAN, D_LOCAL_STID_CLEAN, "
             "D_AGENCYCODE_CLEAN, FLAG_REASON")
ORACLE["settings_join_flags"] = f"""WITH {PARTNER_CTES}
SELECT {_FLAG_OUT}, {sql_list_text('SETTINGS_GRADE_LIST')} AS SETTINGS_GRADE_LIST, SPLIT FROM split"""


def _applies(col: str, reasons: list[str], cast: bool = False) -> str:
    cond = " OR ".join(f"contains(FLAG_REASON, '{r}')" for r in reasons)
    v = f"CAST({col} AS VARCHAR)" if cast else col
    return f"CASE WHEN {cond} THEN {v} END AS {col}"


ORACLE["flag_summary"] = f"""WITH {PARTNER_CTES},
keyed AS (SELECT FLAG_REASON, D_FILENAMEFROMDISTRICT, D_SUBJECT,
  {_applies('D_GRADE', ['grade_not_in_study', 'missing_grade'])},
  {_applies('D_GRADE_CLEAN', ['grade_not_in_study'], True)},
  {_applies('D_SS', ['non_numeric_SS'])},
  {_applies('D_TERM', ['incorrect_term'])},
  {_applies('SETTINGS_TERM', ['incorrect_term', 'test_date_out_of_range'])},
  {_applies('D_TESTDATE', ['test_date_out_of_range'])},
  {_applies('D_TESTDATE_CLEAN', ['test_date_out_of_range'])}
  FROM split WHERE SPLIT = 'flagged'),
cnt AS (SELECT *, count(*) AS record_count FROM keyed GROUP BY ALL),
tot AS (SELECT D_FILENAMEFROMDISTRICT, D_SUBJECT, count(*) AS total_partner_subject_records
        FROM split WHERE SPLIT = 'kept' GROUP BY ALL)
SELECT cnt.*, tot.total_partner_subject_records,
       round_even(CAST(cnt.record_count AS DOUBLE) * 100.0 / tot.total_partner_subject_records, 1) AS pct_affected_records
FROM cnt LEFT JOIN tot ON cnt.D_FILENAMEFROMDISTRICT IS NOT DISTINCT FROM tot.D_FILENAMEFROMDISTRICT
 AND cnt.D_SUBJECT IS NOT DISTINCT FROM tot.D_SUBJECT"""

ORACLE["long_counts_subject_grade"] = f"""WITH {PARTNER_CTES}
SELECT D_SUBJECT, D_GRADE_CLEAN, count(*) AS record_count FROM split WHERE SPLIT = 'kept' GROUP BY ALL"""


def _missingness(src: str, groups: list[str], cols: list[str], text_cols: set[str]) -> str:
    def miss(c):
        m = f"{c} IS NULL"
        if c in text_cols:
            m += f" OR regexp_full_match({c}, '\\s*')"
        return m
    g = ", ".join(groups)
    parts = [f"SELECT {g}, '{c}' AS col_name, count(*) AS total_count, "
             f"count(*) FILTER (WHERE {miss(c)}) AS missing_count FROM {src} GROUP BY {g}" for c in cols]
    return (f"SELECT {g}, col_name, total_count, missing_count, total_count - missing_count AS non_missing_count, "
            f"round_even(CAST(missing_count AS DOUBLE) * 100.0 / total_count, 2) AS missing_percentage "
            f"FROM ({' UNION ALL '.join(parts)})")


ORACLE["missingness_by_group"] = (
    "WITH dl AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)\n"
    + _missingness("dl", ["lang", "source"], ["doc_id", "text", "n_chars", "quality", "toxic"], {"text"}))

_WIDE_MISS = [c for c in WIDE_COLS if c not in ("RECORD_ID", "GRADE", "FILENAMEFROMDISTRICT")]
ORACLE["missingness_wide"] = (f"WITH {WIDE_CTE}\n"
                              + _missingness("wide", ["GRADE", "FILENAMEFROMDISTRICT"], _WIDE_MISS, set(_WIDE_MISS)))


# ---------------------------------------------------------------------------
# Vendor event extract
# ---------------------------------------------------------------------------
from .roles import ETHNIC_NAMES  # noqa: E402
from ..config import ETHNIC_GROUP_CODES  # noqa: E402

_ETH_CASE = "CASE n_nationkey % 9 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(ETHNIC_NAMES)) + " END"
_ETH_CODE = "CASE ethnic_group_name " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in ETHNIC_GROUP_CODES.items()) + " END"

EXTRACT_CTE = f"""
schools AS (
  SELECT s.s_suppkey AS school_business_identifier, s.s_name AS school_standard_name,
         r.r_name AS state, CAST(n.n_nationkey AS BIGINT) AS district_business_identifier,
         n.n_name AS district_standard_name, lpad(CAST(n.n_nationkey AS VARCHAR), 4, '0') AS district_agency_code
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
stu AS (
  SELECT c.c_custkey AS student_bid, CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'MALE' END AS gender,
         ' ' || lower(c.c_mktsegment) AS name_first, c.c_name AS name_last,
         CASE WHEN c.c_custkey % 10 = 0 THEN 'X' || CAST(c.c_custkey AS VARCHAR) ELSE CAST(c.c_custkey AS VARCHAR) END
           AS state_student_external_id,
         CAST(c.c_custkey + 100000 AS VARCHAR) AS district_student_external_id,
         DATE '{DOB_BASE}' + CAST(c.c_custkey % 7000 AS INTEGER) AS date_of_birth, eg.ethnic_group_name
  FROM customer c LEFT JOIN (SELECT CAST(n_nationkey AS BIGINT) AS ethnic_group_id, {_ETH_CASE} AS ethnic_group_name
                             FROM nation) eg ON CAST(c.c_nationkey AS BIGINT) = eg.ethnic_group_id),
tst AS (
  SELECT p_partkey AS test_id, p_brand AS name, 'T-' || CAST(p_partkey AS VARCHAR) || '-' || CAST(p_size AS VARCHAR) AS test_bid,
         CAST(p_size AS INTEGER) AS grade_bid, p_type AS subject FROM part WHERE p_brand IN ({_TESTS})),
cst AS (
  SELECT p_partkey AS test_key, CAST(p_size % 6 + 1 AS INTEGER) AS test_grade_low, CAST(p_size % 6 + 6 AS INTEGER) AS test_grade_high,
         CASE WHEN p_size % 2 = 0 THEN 'EN' ELSE 'ES' END AS language_id FROM part WHERE p_type <> 'PROMO'),
evt AS (
  SELECT l.l_orderkey * 8 + l.l_linenumber AS test_event_bid, o.o_custkey AS student_bid, l.l_suppkey AS school_bid,
         l.l_partkey AS test_id, CAST(year(o.o_orderdate) AS INTEGER) AS term_number, l.l_extendedprice AS score,
         l.l_tax * 10 + l.l_discount AS standard_error, CAST(l.l_shipdate AS DATE) AS event_end_date,
         CAST(l.l_linenumber + 5 AS INTEGER) AS measurement_scale_bid, l.l_linestatus = 'F' AS growth_event_yn
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_returnflag <> 'R' AND l.l_linestatus = 'F' AND l.l_extendedprice IS NOT NULL),
x AS (
  SELECT e.test_event_bid AS test_event_business_identifier, sc.state, sc.district_business_identifier,
         sc.district_standard_name, sc.district_agency_code, sc.school_business_identifier, sc.school_standard_name,
         CAST(CASE WHEN t.grade_bid IN (13, 16, 17) THEN 0 WHEN t.grade_bid = 14 THEN -1
              WHEN t.grade_bid BETWEEN 1 AND 12 THEN t.grade_bid END AS INTEGER) AS grade_ordinal,
         e.student_bid AS student_business_identifier, s.ethnic_group_name,
         CAST({_ETH_CODE.replace('ethnic_group_name', 's.ethnic_group_name')} AS INTEGER) AS ethnic_group_code,
         CAST(round(e.score) AS INTEGER) AS irit, CAST(e.standard_error AS DECIMAL(5,2)) AS sem,
         t.name AS test_name, t.test_bid AS test_key, s.gender AS student_gender,
         upper(trim(s.name_first)) AS student_first_name, upper(trim(s.name_last)) AS student_last_name,
         TRY_CAST(s.state_student_external_id AS DECIMAL(38,0)) AS student_state_id,
         TRY_CAST(s.district_student_external_id AS DECIMAL(38,0)) AS student_id,
         CASE WHEN e.measurement_scale_bid = 12 THEN 7 ELSE e.measurement_scale_bid END AS measurement_scale_bid,
         e.measurement_scale_bid AS measurement_scale_bid_raw, t.subject, e.term_number,
         c.test_grade_low, c.test_grade_high, e.event_end_date AS testdate, c.language_id,
         s.date_of_birth AS dob, CAST(strftime(date_trunc('month', s.date_of_birth), '%Y%m') AS INTEGER) AS dob_yyyy_mm,
         e.score AS _score, e.growth_event_yn
  FROM evt e JOIN schools sc ON e.school_bid = sc.school_business_identifier
  JOIN stu s ON e.student_bid = s.student_bid
  JOIN tst t ON e.test_id = t.test_id
  LEFT JOIN cst c ON TRY_CAST(TRY_CAST(split_part(t.test_bid, '-', 2) AS DECIMAL(38,0)) AS BIGINT) = c.test_key),
extract AS (
  SELECT * EXCLUDE (_score), CAST(row_number() OVER (PARTITION BY student_business_identifier, term_number,
      measurement_scale_bid_raw ORDER BY _score DESC NULLS LAST, test_event_business_identifier, test_key,
      school_business_identifier, testdate, sem) AS INTEGER) AS score_rank FROM x)"""

ORACLE["event_extract"] = f"WITH {EXTRACT_CTE}\nSELECT * FROM extract"
ORACLE["score_rank"] = (f"WITH {EXTRACT_CTE}\nSELECT student_business_identifier, term_number, measurement_scale_bid_raw, "
                        "test_event_business_identifier, test_key, irit, score_rank FROM extract")


# ---------------------------------------------------------------------------
# Linkage (naive OR-join + QUALIFY: the definition our lookup plan must equal)
# ---------------------------------------------------------------------------
def _nk(x: str) -> str:
    return f"upper(regexp_replace({x}, '[^A-Z]', '', 'g'))"


def _idk(x: str) -> str:
    return f"NULLIF(trim(CAST({x} AS VARCHAR)), '')"


LINK_CTE = f"""
partner AS (
  SELECT concat_ws('|', D_RECORD_ID, D_SUBJECT, SETTINGS_VENDOR_TEST_NAME) AS p_id,
         SETTINGS_VENDOR_TEST_NAME AS test_name, {_idk('D_STATE_STID_CLEAN')} AS state_key,
         {_idk('D_LOCAL_STID_CLEAN')} AS local_key, {_nk('D_FNAME')} AS fname_key, {_nk('D_LNAME')} AS lname_key,
         D_DOB_DATE AS dob, D_SEX, D_GRADE_CLEAN, D_STATE_STID, D_LOCAL_STID, D_DOB, D_FILENAMEFROMDISTRICT,
         CAST(D_STATE_STID_CLEAN AS DECIMAL(38,0)) AS state_id, CAST(D_LOCAL_STID_CLEAN AS DECIMAL(38,0)) AS local_id,
         D_AGENCYCODE AS agency_code, D_LNAME AS lname, D_FNAME AS fname
  FROM split WHERE SPLIT = 'kept'),
vraw AS (
  SELECT o.o_orderkey AS m_id, c.c_custkey AS student_business_identifier,
         'Brand#' || CAST(o.o_orderkey % 5 + 1 AS VARCHAR) AS test_name,
         'T-' || CAST(o.o_orderkey % 5 + 1 AS VARCHAR) || '-' || CAST(year(o.o_orderdate) AS VARCHAR) AS test_key,
         CASE WHEN c.c_custkey % 10 = 0 THEN 'X' || CAST(c.c_custkey AS VARCHAR) ELSE CAST(c.c_custkey AS VARCHAR) END AS sid_txt,
         CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE CAST(c.c_custkey + 100000 AS VARCHAR) END AS lid_txt,
         lpad(CAST(c.c_nationkey AS VARCHAR), 3, '0') AS district_agency_code,
         upper(trim(c.c_mktsegment)) AS student_first_name, upper(trim(c.c_name)) AS student_last_name,
         CASE WHEN o.o_orderkey % 9 = 0 THEN DATE '{DOB_BASE}' + CAST(c.c_custkey % 7000 AS INTEGER) + 1
              ELSE DATE '{DOB_BASE}' + CAST(c.c_custkey % 7000 AS INTEGER) END AS r_dob,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'MALE' END AS M_SEX
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
vendor AS (
  SELECT *, TRY_CAST(sid_txt AS DECIMAL(38,0)) AS student_state_id, TRY_CAST(lid_txt AS DECIMAL(38,0)) AS student_id,
         {_idk('TRY_CAST(sid_txt AS DECIMAL(38,0))')} AS state_key, {_idk('TRY_CAST(lid_txt AS DECIMAL(38,0))')} AS local_key,
         {_nk('student_first_name')} AS fname_key, {_nk('student_last_name')} AS lname_key, r_dob AS dob
  FROM vraw),
cand AS (
  SELECT v.m_id, v.student_business_identifier, v.test_key, p.*, v.student_state_id AS M_STATE_STID,
         v.student_id AS M_LOCAL_STID, v.r_dob AS R_DOB, v.M_SEX,
         CASE WHEN (p.state_key = v.state_key OR p.local_key = v.local_key) AND p.fname_key = v.fname_key
                   AND p.lname_key = v.lname_key AND p.dob = v.dob THEN 1
              WHEN (p.state_key = v.state_key OR p.local_key = v.local_key) AND p.dob = v.dob THEN 3
              ELSE 4 END AS phase_rank
  FROM partner p JOIN vendor v ON p.test_name = v.test_name
   AND (p.state_key = v.state_key OR p.local_key = v.local_key OR p.dob = v.dob))"""

_PHASE = ("CASE phase_rank WHEN 1 THEN 'PHASE_1_FULL_ID_NAME_DOB' WHEN 2 THEN 'PHASE_2_ID_NAME_DOB' "
          "WHEN 3 THEN 'PHASE_3_ID_DOB' ELSE 'UNMATCHED' END")
_SEX = ("COALESCE(CASE WHEN upper(D_SEX) IN ('M','MALE','1') THEN 1 WHEN upper(D_SEX) IN ('F','FEMALE','0') THEN 0 END, "
        "CASE WHEN upper(M_SEX) IN ('M','MALE','1') THEN 1 WHEN upper(M_SEX) IN ('F','FEMALE','0') THEN 0 END)")
_BEST = f"""best AS (
  SELECT {_PHASE} AS MATCH_TYPE, student_business_identifier, test_key, m_id, p_id, D_SEX, D_GRADE_CLEAN,
         D_STATE_STID, D_LOCAL_STID, D_DOB, D_FILENAMEFROMDISTRICT, M_STATE_STID, M_LOCAL_STID, R_DOB, M_SEX,
         {_SEX} AS SEX, 'ZZ' AS STATE
  FROM cand QUALIFY row_number() OVER (PARTITION BY student_business_identifier, test_key
                                       ORDER BY phase_rank, p_id, m_id) = 1)"""

ORACLE["link_best"] = f"WITH {PARTNER_CTES},\n{LINK_CTE},\n{_BEST}\nSELECT * FROM best"
ORACLE["link_phases"] = f"""WITH {PARTNER_CTES},\n{LINK_CTE}
SELECT m_id, student_business_identifier, test_key, {_PHASE} AS MATCH_TYPE, p_id
FROM cand QUALIFY row_number() OVER (PARTITION BY m_id ORDER BY phase_rank, p_id) = 1"""
ORACLE["match_rates"] = f"""WITH {PARTNER_CTES},\n{LINK_CTE},\n{_BEST},
c AS (SELECT MATCH_TYPE, D_GRADE_CLEAN, count(*) AS n FROM best GROUP BY ALL)
SELECT *, sum(n) OVER (PARTITION BY D_GRADE_CLEAN) AS grade_total,
       round_even(CAST(n AS DOUBLE) * 100.0 / sum(n) OVER (PARTITION BY D_GRADE_CLEAN), 2) AS pct_of_grade FROM c"""
ORACLE["link_legacy"] = f"""WITH {PARTNER_CTES},\n{LINK_CTE}
SELECT CASE WHEN v.student_state_id = p.state_id THEN 'STATE_STID'
            WHEN p.local_id = v.student_id AND p.agency_code = v.district_agency_code THEN 'LOCAL'
            WHEN p.lname = v.student_last_name AND p.fname = v.student_first_name AND p.dob = v.r_dob THEN 'FUZZY'
            ELSE 'UNMATCHED' END AS MATCH_TYPE,
       p.p_id, v.m_id, v.student_business_identifier, p.test_name
FROM partner p JOIN vendor v
  ON (v.test_name = p.test_name AND v.student_state_id = p.state_id)
  OR (v.test_name = p.test_name AND p.agency_code = v.district_agency_code AND p.local_id = v.student_id)
  OR (v.test_name = p.test_name AND p.agency_code = v.district_agency_code AND p.lname = v.student_last_name
      AND p.fname = v.student_first_name AND p.dob = v.r_dob)"""


# ---------------------------------------------------------------------------
# Intake
# ---------------------------------------------------------------------------
from .roles import INTAKE_EXPECTED_COLS, INTAKE_HEADER  # noqa: E402


def _fname(ck: str) -> str:
    return f"('district file ' || lpad(CAST({ck} AS VARCHAR), 5, '0') || '.csv')"


def _opt(cond: str, v: str) -> str:
    return f"CASE WHEN {cond} THEN [{v}] ELSE CAST([] AS VARCHAR[]) END"


_HDR = "[" + ", ".join(f"'{h}'" for h in INTAKE_HEADER) + "]"
INTAKE_CTE = f"""
cells AS (
  SELECT {_fname('c_custkey')} AS file_name, CAST(0 AS BIGINT) AS row_idx,
         list_concat(list_concat({_HDR}, {_opt('c_custkey % 7 = 0', "'EXTRA'")}), {_opt('c_custkey % 5 = 0', "'AGENCYCODE'")}) AS cells,
         CAST(NULL AS VARCHAR) AS read_error FROM customer WHERE c_custkey % 13 <> 0
  UNION ALL
  SELECT {_fname('c_custkey')}, 0, NULL, 'decode error' FROM customer WHERE c_custkey % 13 = 0
  UNION ALL
  SELECT {_fname('o_custkey')}, o_orderkey + 1,
         list_concat(list_concat(CASE WHEN o_orderstatus = 'P' THEN ['', ' ', '', '', '']
              ELSE [CAST(o_orderkey AS VARCHAR), o_orderstatus, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR),
                    strftime(o_orderdate, '%Y-%m-%d'), o_orderpriority] END,
              {_opt('o_custkey % 7 = 0', "'x'")}), {_opt('o_custkey % 5 = 0', "lpad(CAST(o_custkey % 100 AS VARCHAR), 3, '0')")}),
         NULL FROM orders WHERE o_custkey % 13 <> 0),
pf AS (
  SELECT file_name, CAST(max(CASE WHEN row_idx = 0 THEN len(cells) END) AS INTEGER) AS received_cols,
         CAST(max(CASE WHEN row_idx = 0 THEN len(list_filter(cells, lambda h: upper(trim(h)) NOT IN
              ('AGENCYCODE', 'AGENCY_CODE', 'FILENAMEFROMDISTRICT'))) END) AS INTEGER) AS own_cols,
         count(*) FILTER (WHERE row_idx > 0 AND len(list_filter(cells, lambda c: c IS NOT NULL
              AND NOT regexp_full_match(c, '\\s*'))) > 0) AS non_blank_records,
         max(read_error) AS read_error
  FROM cells GROUP BY file_name),
verdicts AS (
  SELECT file_name, {INTAKE_EXPECTED_COLS} AS expected_cols, received_cols,
         CASE WHEN read_error IS NULL THEN non_blank_records END AS non_blank_records,
         CASE WHEN read_error IS NULL THEN CASE WHEN received_cols = {INTAKE_EXPECTED_COLS} THEN 'WORKING_FILES'
              ELSE 'REJECTED_FILES' END END AS STATUS,
         CASE WHEN read_error IS NULL AND received_cols <> {INTAKE_EXPECTED_COLS}
              THEN printf('expected_cols=%d; received_cols=%d', {INTAKE_EXPECTED_COLS}, received_cols) END AS notes,
         read_error
  FROM pf),
newrows AS (
  SELECT file_name AS original_file, '2025-09-01' AS date_ingested,
         CASE WHEN read_error IS NULL THEN CAST(non_blank_records AS VARCHAR) END AS non_blank_records,
         CASE WHEN read_error IS NULL THEN STATUS END AS STATUS,
         CASE WHEN read_error IS NULL THEN notes END AS notes, CAST(NULL AS VARCHAR) AS notes2 FROM verdicts),
oldlog AS (
  SELECT upper({_fname('c_custkey')}) AS original_file, '2025-01-01' AS date_ingested,
         CAST(NULL AS VARCHAR) AS non_blank_records, 'REJECTED_FILES' AS STATUS, 'first drop' AS notes,
         CAST(NULL AS VARCHAR) AS notes2 FROM customer WHERE c_custkey % 4 = 0)"""

ORACLE["intake_routing"] = f"WITH {INTAKE_CTE}\nSELECT * FROM verdicts"
ORACLE["log_upsert"] = f"""WITH {INTAKE_CTE}
SELECT COALESCE(o.original_file, n.original_file) AS original_file,
       COALESCE(o.date_ingested, n.date_ingested) AS date_ingested,
       COALESCE(o.non_blank_records, n.non_blank_records) AS non_blank_records,
       CASE WHEN n.original_file IS NOT NULL THEN n.STATUS ELSE o.STATUS END AS STATUS,
       CASE WHEN o.original_file IS NOT NULL THEN COALESCE(o.notes, n.notes) ELSE n.notes END AS notes,
       CASE WHEN o.original_file IS NOT NULL THEN COALESCE(o.notes2, n.notes2) ELSE n.notes2 END AS notes2
FROM oldlog o FULL OUTER JOIN newrows n ON lower(o.original_file) = lower(n.original_file)"""
ORACLE["log_new_files"] = f"""WITH {INTAKE_CTE}
SELECT * FROM oldlog
UNION ALL
SELECT * FROM newrows n WHERE NOT EXISTS (SELECT 1 FROM oldlog o WHERE lower(o.original_file) = lower(n.original_file))"""


# ---------------------------------------------------------------------------
# Smaller operators
# ---------------------------------------------------------------------------
ORACLE["combine_template"] = f"""WITH {INTAKE_CTE},
hdr AS (SELECT file_name, list_transform(cells, lambda h: upper(trim(h)) NOT IN ('AGENCYCODE', 'AGENCY_CODE',
        'FILENAMEFROMDISTRICT')) AS keep FROM cells WHERE row_idx = 0),
body AS (SELECT c.file_name, list_filter(c.cells, lambda x, i: h.keep[i]) AS c
         FROM cells c JOIN hdr h ON c.file_name = h.file_name
         WHERE c.row_idx > 0 AND c.file_name IN (SELECT file_name FROM pf WHERE own_cols = {INTAKE_EXPECTED_COLS}))
SELECT {', '.join(f"{_nb(f'c[{i + 1}]')} AS {h}" for i, h in enumerate(INTAKE_HEADER))}, file_name AS FILENAMEFROMDISTRICT,
       NULLIF(regexp_extract(file_name, '(?i)(?:^|[ _-])([0-9]+)\\.(?:xlsx|csv)$', 1), '') AS AGENCYCODE
FROM body"""

ORACLE["skip_report"] = f"""WITH {INTAKE_CTE}
SELECT file_name AS FILE, CASE WHEN read_error IS NOT NULL THEN 'UNREADABLE' ELSE 'COL_MISMATCH' END AS REASON,
       COALESCE(read_error, printf('expected %d, got %d', {INTAKE_EXPECTED_COLS}, own_cols)) AS DETAIL
FROM pf WHERE read_error IS NOT NULL OR own_cols <> {INTAKE_EXPECTED_COLS}"""

_ENAME = f"'edited_' || {_fname('c_custkey')}"
ORACLE["edited_promotion"] = f"""WITH {INTAKE_CTE},
ed AS (SELECT c_custkey AS k, {_ENAME} AS f, 5 + c_custkey % 2 AS got, c_custkey % 13 = 0 AS bad,
              (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer WHERE c_custkey % 7 = 0),
nw AS (SELECT f, CASE WHEN NOT bad THEN CAST(n AS VARCHAR) END AS n,
              CASE WHEN NOT bad THEN CASE WHEN k % 21 = 0 THEN 'REJECTED_FILES' WHEN got = 5 THEN 'EDITED_WORKING'
                   ELSE 'EDITED_REJECTED' END END AS st,
              CASE WHEN NOT bad AND got <> 5 THEN 'expected_cols=5; received_cols=6' END AS nt FROM ed),
old AS (SELECT * FROM oldlog UNION ALL
        SELECT {_ENAME}, '2025-02-02', '1', 'EDITED_REJECTED', NULL, 'by hand' FROM customer WHERE c_custkey % 28 = 0)
SELECT COALESCE(original_file, f) AS original_file, COALESCE(date_ingested, '2025-09-01') AS date_ingested,
       COALESCE(non_blank_records, n) AS non_blank_records, CASE WHEN f IS NOT NULL THEN st ELSE STATUS END AS STATUS,
       COALESCE(notes, nt) AS notes, notes2
FROM old FULL OUTER JOIN nw ON lower(original_file) = lower(f)"""


def _slice(prios: str, batch: str) -> str:
    return (f"SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, "
            f"o_orderpriority, '{batch}' AS source_file FROM orders WHERE o_orderpriority IN ({prios})")


ORACLE["insert_if_absent"] = f"""WITH t AS ({_slice("'1-URGENT', '2-HIGH', '3-MEDIUM'", 'batch_a.csv')}),
s AS ({_slice("'2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'", 'batch_b.csv')})
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey IS NOT DISTINCT FROM s.o_orderkey
  AND t.o_custkey IS NOT DISTINCT FROM s.o_custkey AND t.status IS NOT DISTINCT FROM s.status
  AND t.o_orderpriority IS NOT DISTINCT FROM s.o_orderpriority)"""

ORACLE["reject_antijoin"] = """SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'
AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')"""

_REASONS = {"1-URGENT": "removed_DOB", "2-HIGH": "removed_gradeRange", "3-MEDIUM": "removed_noScores",
            "4-NOT SPECIFIED": "removed_Lname", "5-LOW": "removed_Fname"}
ORACLE["reason_pivot"] = ("SELECT lpad(CAST(c.c_nationkey AS VARCHAR), 3, '0') AS AGENCYCODE, "
                          + ", ".join(f"count(*) FILTER (WHERE o.o_orderpriority = '{k}') AS {v}" for k, v in _REASONS.items())
                          + " FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1")

ORACLE["tests_by_grade"] = (f"WITH {WIDE_CTE}\nSELECT {sql_clean_grade('GRADE')} AS GRADE_CLEAN, "
                            + ", ".join(f"count({s}_SS) AS n_{s}_SS" for _, s in PARTNER_SUBJECTS)
                            + " FROM wide GROUP BY 1")

_EXPORT_DROP = {"SCI_SS", "SCI_PLCODE", "SCI_TESTDATE", "DOB"}
ORACLE["any_score_export"] = (f"WITH {WIDE_CTE}\nSELECT {', '.join(c for c in WIDE_COLS if c not in _EXPORT_DROP)} "
                              "FROM wide WHERE MATH_SS IS NOT NULL OR ELA_SS IS NOT NULL")


def _messy_name(k: str, n: str) -> str:
    n4 = f"lpad(CAST({n} AS VARCHAR), 4, '0')"
    ns = f"CAST({n} AS VARCHAR)"
    return (f"CASE {k} % 6 WHEN 0 THEN 'North District ' || {n4} || '.csv' WHEN 1 THEN 'south_' || {ns} || '.CSV' "
            f"WHEN 2 THEN 'West' || {ns} || '.csv' WHEN 3 THEN 'East-' || {ns} || '.xlsx' "
            f"WHEN 4 THEN 'edited_East-' || {ns} || '.csv' ELSE {ns} || ' files v2.txt' END")


ORACLE["agency_code"] = f"""WITH f AS (SELECT o.o_orderkey, {_messy_name('o.o_orderkey', 'c.c_nationkey')} AS file_name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT o_orderkey, file_name,
  NULLIF(regexp_extract(file_name, '(?i)(?:^|[ _-])([0-9]+)\\.(?:xlsx|csv)$', 1), '') AS agency_code,
  regexp_extract_all(file_name, '[0-9]+')[-1] AS agency_code_legacy,
  regexp_matches(file_name, '(?i)^edited_') AS is_edited,
  regexp_replace(file_name, '(?i)^edited_', '') AS original_name
FROM f"""

ORACLE["name_key"] = """WITH n AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN lower(c_name)
  WHEN 2 THEN 'Ann-Lee ' || CAST(c_custkey AS VARCHAR) ELSE upper(c_mktsegment) END AS raw_name FROM customer)
SELECT c_custkey, raw_name, upper(regexp_replace(raw_name, '[^A-Z]', '', 'g')) AS name_key,
       regexp_replace(upper(raw_name), '[^A-Z]', '', 'g') AS name_key_folded FROM n"""


def _grade_text(k: str, c: str) -> str:
    lo, hi = f"CAST({c} % 13 AS VARCHAR)", f"CAST({k} % 13 AS VARCHAR)"
    return (f"CASE {k} % 5 WHEN 0 THEN {lo} || '-' || {hi} WHEN 1 THEN {lo} || ', ' || {hi} "
            f"WHEN 2 THEN 'K-' || {hi} WHEN 3 THEN 'GRADE ' || {lo} || ';' || {hi} || ' 3 - 5' "
            f"ELSE 'grade ' || {hi} END")


ORACLE["grade_list_parse"] = f"""WITH p AS (SELECT o_orderkey, o_orderstatus, {_grade_text('o_orderkey', 'o_custkey')} AS grades_text
  FROM orders),
q AS (SELECT *, {sql_grade_list('grades_text')} AS gl FROM p),
s AS (SELECT o_orderstatus, list_sort(list_distinct(flatten(list(gl)))) AS sg FROM q GROUP BY 1)
SELECT q.o_orderkey, q.o_orderstatus, q.grades_text, {sql_list_text('q.gl')} AS grade_list,
       {sql_list_text('s.sg')} AS status_grades FROM q JOIN s ON q.o_orderstatus = s.o_orderstatus"""

ORACLE["counts_subject"] = f"""WITH {PARTNER_CTES}
SELECT D_SUBJECT, count(*) AS record_count FROM split WHERE SPLIT = 'kept' GROUP BY ALL"""


# ---------------------------------------------------------------------------
# Filters, roster, older checks, merge counts
# ---------------------------------------------------------------------------
from .roles import LEGACY_GRADES, ONE_STATE, ONE_TERM, SOME_SCALES, SOME_TESTS  # noqa: E402

_SOME = ", ".join(f"'{t}'" for t in SOME_TESTS)
_ONE = f"TERM_NUMBER = {ONE_TERM} AND DISTRICT_GEOGRAPHY_NAME = '{ONE_STATE}'"
ORACLE["counts_total_by_test_filtered"] = f"""WITH {EVENT_VIEW}
SELECT {_BASE}, count(*) AS test_count FROM ev
WHERE {_ONE} AND MEASUREMENT_SCALE_BID IN ({', '.join(map(str, SOME_SCALES))}) AND GROWTH_EVENT_YN GROUP BY {_BASE}"""
ORACLE["counts_by_grade_filtered"] = f"""WITH {EVENT_VIEW}
SELECT {_BASE}, GRADE_ORDINAL AS GRADE, {_COUNTS} FROM ev
WHERE {_ONE} AND ASSESS_SCORE IS NOT NULL AND TEST_NAME IN ({_SOME}) GROUP BY {_BASE}, GRADE_ORDINAL"""
ORACLE["counts_by_district_grade_filtered"] = f"""WITH {EVENT_VIEW}
SELECT {_DIST}, GRADE_ORDINAL AS GRADE, {_COUNTS} FROM ev
WHERE {_ONE} AND ASSESS_SCORE IS NOT NULL AND TEST_NAME IN ({_SOME}) GROUP BY {_DIST}, GRADE_ORDINAL"""
ORACLE["term_statement"] = f"""WITH {EVENT_VIEW}
SELECT TEST_NAME, GRADE_ORDINAL, count(*) AS test_count, count(DISTINCT STUDENT_BUSINESS_IDENTIFIER) AS student_count
FROM ev WHERE {_ONE} AND ASSESS_SCORE IS NOT NULL AND TEST_NAME IN ({_SOME}) GROUP BY TEST_NAME, GRADE_ORDINAL"""

_STU_ID = "TRY_CAST({} AS DECIMAL(38,0))"
ORACLE["event_extract_term"] = f"""
WITH first_school AS (SELECT s_nationkey, min(s_suppkey) AS school FROM supplier GROUP BY 1),
stu AS (
  SELECT r.r_name AS state, CAST(n.n_nationkey AS BIGINT) AS district_business_identifier, n.n_name AS district_standard_name,
         lpad(CAST(n.n_nationkey AS VARCHAR), 4, '0') AS district_agency_code, s.s_suppkey AS school_business_identifier,
         s.s_name AS school_standard_name, y.y AS term_number, (c.c_custkey + y.y) % 18 AS g, c.c_custkey AS k,
         CASE n.n_nationkey % 9 {' '.join(f"WHEN {i} THEN '{e}'" for i, e in enumerate(ETHNIC_NAMES))} END AS ethnic_group_name,
         c.c_mktsegment, c.c_name
  FROM customer c JOIN (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders) y ON y.o_custkey = c.c_custkey
  JOIN first_school f ON f.s_nationkey = c.c_nationkey JOIN supplier s ON s.s_suppkey = f.school
  JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
  WHERE y.y = {ONE_TERM} AND r.r_name = '{ONE_STATE}'),
x AS (
  SELECT l.l_orderkey * 8 + l.l_linenumber AS test_event_business_identifier, stu.*, l.*, p.p_brand, p.p_partkey, p.p_size, p.p_type
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN stu ON o.o_custkey = stu.k AND year(o.o_orderdate) = stu.term_number
  JOIN part p ON p.p_partkey = l.l_partkey
  WHERE l.l_returnflag <> 'R' AND l.l_linestatus = 'F' AND l.l_extendedprice IS NOT NULL AND p.p_brand IN ({_SOME}))
SELECT test_event_business_identifier, state, district_business_identifier, district_standard_name, district_agency_code,
       school_business_identifier, school_standard_name,
       CAST(CASE WHEN g IN (13, 16, 17) THEN 0 WHEN g = 14 THEN -1 WHEN g BETWEEN 1 AND 12 THEN g END AS INTEGER) AS grade_ordinal,
       k AS student_business_identifier, ethnic_group_name, CAST({_ETH_CODE} AS INTEGER) AS ethnic_group_code,
       CAST(round(l_extendedprice) AS INTEGER) AS irit, CAST(l_tax * 10 + l_discount AS DECIMAL(5,2)) AS sem, p_brand AS test_name,
       'T-' || CAST(p_partkey AS VARCHAR) || '-' || CAST(p_size AS VARCHAR) AS test_key,
       CASE WHEN k % 2 = 0 THEN 'F' ELSE 'MALE' END AS student_gender, upper(c_mktsegment) AS student_first_name,
       upper(trim(c_name)) AS student_last_name,
       CASE WHEN k % 10 <> 0 THEN CAST(k AS DECIMAL(38,0)) END AS student_state_id, CAST(k + 100000 AS DECIMAL(38,0)) AS student_id,
       CAST(CASE WHEN l_linenumber = 7 THEN 7 ELSE l_linenumber + 5 END AS INTEGER) AS measurement_scale_bid,
       CAST(l_linenumber + 5 AS INTEGER) AS measurement_scale_bid_raw, 'Subject ' || CAST(l_linenumber AS VARCHAR) AS subject, term_number,
       CASE WHEN p_type <> 'PROMO' THEN CAST(p_size % 6 + 1 AS INTEGER) END AS test_grade_low,
       CASE WHEN p_type <> 'PROMO' THEN CAST(p_size % 6 + 6 AS INTEGER) END AS test_grade_high, CAST(l_shipdate AS DATE) AS testdate,
       CASE WHEN p_type <> 'PROMO' THEN CASE WHEN p_size % 2 = 0 THEN 'EN' ELSE 'ES' END END AS language_id,
       DATE '{DOB_BASE}' + CAST(k % 7000 AS INTEGER) AS dob,
       CAST(strftime(DATE '{DOB_BASE}' + CAST(k % 7000 AS INTEGER), '%Y%m') AS INTEGER) AS dob_yyyy_mm,
       CAST(row_number() OVER (PARTITION BY k, term_number, l_linenumber ORDER BY l_extendedprice DESC, test_event_business_identifier,
            school_business_identifier) AS INTEGER) AS score_rank, l_linestatus = 'F' AS growth_event_yn
FROM x"""

ORACLE["event_view_roster"] = f"""
WITH ev AS (
  SELECT l.l_orderkey * 8 + l.l_linenumber AS test_event_business_identifier, r.r_name AS state,
         CAST(year(o.o_orderdate) AS INTEGER) AS term_number, c.c_custkey AS student_business_identifier, p.p_brand AS test_name,
         CAST(c.c_custkey % 12 + 1 AS INTEGER) AS grade_ordinal, CAST(p.p_size % 6 + 1 AS INTEGER) AS test_grade_low,
         CAST(p.p_size % 6 + 6 AS INTEGER) AS test_grade_high, l.l_extendedprice AS score,
         CAST(l.l_linenumber + 5 AS INTEGER) AS measurement_scale_bid_raw
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
  WHERE l.l_returnflag <> 'R' AND l.l_extendedprice IS NOT NULL AND p.p_brand IN ({_TESTS})
    AND c.c_custkey % 12 + 1 BETWEEN p.p_size % 6 + 1 AND p.p_size % 6 + 6 AND year(o.o_orderdate) = {ONE_TERM} AND r.r_name = '{ONE_STATE}'),
births AS (
  SELECT DISTINCT o_custkey, DATE '{DOB_BASE}' + CAST(o_custkey % 7000 + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS INTEGER) AS r_dob
  FROM orders WHERE o_custkey % 17 <> 0 AND year(o_orderdate) = {ONE_TERM})
SELECT DISTINCT ev.*, CASE WHEN measurement_scale_bid_raw = 12 THEN 7 ELSE measurement_scale_bid_raw END AS measurement_scale_bid, r_dob,
       CAST(row_number() OVER (PARTITION BY student_business_identifier, term_number, measurement_scale_bid_raw
            ORDER BY score DESC, test_event_business_identifier, r_dob NULLS FIRST) AS INTEGER) AS score_rank
FROM ev LEFT JOIN births ON o_custkey = student_business_identifier"""


def _legacy_fit() -> str:
    out = []
    for c, grades in LEGACY_GRADES.items():
        cond = f"TRY_CAST(trim({c}) AS DECIMAL(38,0)) IS NOT NULL"
        if grades:
            cond += f" AND TRY_CAST(trim(GRADE) AS DECIMAL(38,0)) IN ({', '.join(map(str, grades))})"
        out.append(f"COALESCE({cond}, false)")
    return " OR ".join(out)


_SCORED = " OR ".join(f"TRY_CAST(trim({c}) AS DECIMAL(38,0)) IS NOT NULL" for c in LEGACY_GRADES)
CHECKED_CTE = f"""{WIDE_CTE},
judged AS (SELECT *, {_SCORED} AS scored, {_legacy_fit()} AS fit FROM wide),
reasons AS (
  SELECT *, CASE WHEN NOT scored THEN 'removed_noScores' WHEN NOT fit THEN CASE WHEN EXISTS (SELECT 1 FROM judged k
       WHERE k.fit AND k.STATE_STID IS NOT DISTINCT FROM j.STATE_STID) THEN '_' ELSE 'removed_gradeRange' END
       WHEN LNAME IS NULL THEN 'removed_Lname' WHEN FNAME IS NULL THEN 'removed_Fname' END AS reason FROM judged j),
checked AS (SELECT * FROM reasons WHERE reason IS NULL OR reason <> '_')"""
_SHOWN = ", ".join(f"CASE WHEN reason IS NULL THEN CAST(CAST(TRY_CAST(trim({c}) AS DECIMAL(38,0)) AS BIGINT) AS VARCHAR) ELSE {c} END AS {c}"
                   for c in LEGACY_GRADES)
ORACLE["legacy_checks"] = f"""WITH {CHECKED_CTE}
SELECT reason AS reasonForRemoval, RECORD_ID, STATE_STID, GRADE, {_SHOWN}, strftime({sql_parse_date('DOB')}, '%m-%d-%Y') AS DOB_TEXT
FROM checked"""
_REPORT = ("removed_gradeRange", "removed_noScores", "removed_Lname", "removed_Fname")
ORACLE["district_counts"] = f"""WITH {CHECKED_CTE},
n AS (SELECT AGENCYCODE, NULLIF(count(*) FILTER (WHERE reason IS NULL), 0) AS final_counts,
      {', '.join(f"NULLIF(count(*) FILTER (WHERE reason = '{r}'), 0) AS {r}" for r in _REPORT)} FROM checked GROUP BY 1)
SELECT f.FILENAMEFROMDISTRICT, n.* FROM (SELECT DISTINCT AGENCYCODE, FILENAMEFROMDISTRICT FROM checked) f JOIN n ON n.AGENCYCODE = f.AGENCYCODE"""

ORACLE["merge_rates"] = f"""WITH {PARTNER_CTES},\n{LINK_CTE},\n{_BEST},
hit AS (SELECT p_id, bool_or(MATCH_TYPE <> 'UNMATCHED') AS merged FROM best GROUP BY 1),
g AS (SELECT p.D_GRADE_CLEAN, count(*) AS partner_rows, count(h.merged) AS potential_rows, count(*) FILTER (WHERE h.merged) AS merged_rows
      FROM partner p LEFT JOIN hit h ON h.p_id = p.p_id GROUP BY 1)
SELECT *, round_even(CAST(merged_rows AS DOUBLE) * 100.0 / partner_rows, 2) AS pct_merged FROM g"""

_FILE_MISS = [c for c in WIDE_COLS if c not in ("RECORD_ID", "FILENAMEFROMDISTRICT")]
ORACLE["missingness_by_file"] = f"WITH {WIDE_CTE}\n" + _missingness("wide", ["FILENAMEFROMDISTRICT"], _FILE_MISS, set(_FILE_MISS))
ORACLE["missingness_long_table"] = (
    f"WITH {WIDE_CTE},\n{LONG_CTE},\n{CLEAN_CTE},\n"
    "shown AS (SELECT *, strftime(D_TESTDATE_DATE, '%m/%d/%Y') AS D_TESTDATE_CLEAN, strftime(D_DOB_DATE, '%m/%d/%Y') AS D_DOB_CLEAN FROM clean_long)\n"
    + _missingness("shown", ["D_GRADE_CLEAN", "D_FILENAMEFROMDISTRICT"],
                   ["D_SS", "D_SS_CLEAN", "D_GRADE", "D_TERM", "D_TESTNAME", "D_TESTDATE_CLEAN", "D_DOB_CLEAN", "D_STATE_STID_CLEAN"],
                   {"D_SS", "D_GRADE", "D_TERM", "D_TESTNAME", "D_TESTDATE_CLEAN", "D_DOB_CLEAN"}))


# ---------------------------------------------------------------------------
# Routed files, structure gate, merge, subject codes, saved forms
# ---------------------------------------------------------------------------
ORACLE["routed_lines"] = f"""WITH {INTAKE_CTE}
SELECT v.STATUS, c.file_name, c.row_idx, array_to_string(list_transform(c.cells, lambda x:
         CASE WHEN regexp_matches(x, '[",\\r\\n]') THEN '"' || replace(x, '"', '""') || '"' ELSE coalesce(x, '') END), ',') AS line
FROM cells c JOIN verdicts v ON c.file_name = v.file_name WHERE c.read_error IS NULL AND v.STATUS IS NOT NULL"""

ORACLE["structure_offenders"] = f"""WITH {INTAKE_CTE}
SELECT file_name, 'UNREADABLE' AS problem, read_error AS detail FROM pf WHERE read_error IS NOT NULL
UNION ALL SELECT file_name, 'COL_MISMATCH', printf('expected %d, got %d', {INTAKE_EXPECTED_COLS}, own_cols) FROM pf WHERE own_cols <> {INTAKE_EXPECTED_COLS}
UNION ALL SELECT file_name, 'NO_DISTRICT_CODE', 'no digits in the file name' FROM pf WHERE NOT regexp_matches(file_name, '[0-9]')"""

ORACLE["merge_insert"] = ORACLE["insert_if_absent"].replace("SELECT * FROM s WHERE", "SELECT * FROM t UNION ALL SELECT * FROM s WHERE")

ORACLE["subject_codes"] = f"""WITH {EVENT_VIEW}
SELECT CASE CASE WHEN MEASUREMENT_SCALE_BID = 12 THEN 7 ELSE MEASUREMENT_SCALE_BID END {' '.join(f"WHEN {k} THEN '{v}'" for k, v in SUBJECT_CODES.items())} END AS subject,
       TERM_NUMBER, count(*) AS test_count FROM ev GROUP BY ALL"""

ORACLE["linked_sample"] = ORACLE["link_best"] + " ORDER BY student_business_identifier, test_key"

_SIMPLE = "list_filter(list_transform(string_split(grades_text, ','), lambda t: trim(t)), lambda t: t <> '')"
ORACLE["simple_grades"] = f"""WITH p AS (SELECT o_orderkey, o_orderstatus, {_grade_text('o_orderkey', 'o_custkey')} AS grades_text FROM orders),
t AS (SELECT *, {_SIMPLE} AS tok FROM p),
q AS (SELECT *, CASE WHEN len(list_filter(tok, lambda t: NOT regexp_full_match(t, '[+-]?[0-9]{{1,9}}'))) = 0 THEN list_transform(tok, lambda t: CAST(t AS INTEGER)) END AS g FROM t),
s AS (SELECT o_orderstatus, list_sort(list_distinct(flatten(list(g) FILTER (WHERE g IS NOT NULL)))) AS sg FROM q GROUP BY 1)
SELECT q.o_orderkey, q.o_orderstatus, q.grades_text, {sql_list_text('q.g')} AS grades, {sql_list_text('s.sg')} AS status_grades
FROM q JOIN s ON q.o_orderstatus = s.o_orderstatus"""

_TRIMMED = ("D_RECORD_ID", "D_SUBJECT", "SETTINGS_VENDOR_TEST_NAME", "D_GRADE", "D_SS", "D_TERM", "D_TESTDATE", "FLAG_REASON", "D_LNAME", "D_DISTRICTNAME")
ORACLE["sanitized_flags"] = f"""WITH {PARTNER_CTES}
SELECT {', '.join(f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g') AS {c}" for c in (*_TRIMMED, 'SETTINGS_NOTES'))}, {sql_list_text('SETTINGS_GRADE_LIST')} AS SETTINGS_GRADE_LIST FROM split"""

ORACLE["report_names"] = f"""WITH f AS (SELECT o.o_orderkey, o.o_orderdate, {_messy_name('o.o_orderkey', 'c.c_nationkey')} AS file_name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
e AS (SELECT *, regexp_extract(file_name, '(?s)[^.].*?(\\.[^.]*)$', 1) AS ext FROM f)
SELECT o_orderkey, file_name, left(file_name, length(file_name) - length(ext)) || '_' ||
       strftime(CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400), '%Y%m%d_%H%M%S') || ext AS report_name FROM e"""

_LEG_KEYS = ((("state_id", "student_state_id"),), (("agency_code", "district_agency_code"), ("local_id", "student_id")),
             (("agency_code", "district_agency_code"), ("lname", "student_last_name"), ("fname", "student_first_name"), ("dob", "r_dob")))


def _leg_members(side: int) -> str:
    table, member = (("partner", "p_id"), ("vendor", "m_id"))[side]
    return " UNION ALL ".join(
        f"SELECT {i} AS leg, concat_ws('|', test_name, {', '.join(f'CAST({c[side]} AS VARCHAR)' for c in leg)}) AS class_key, '{table}' AS side, "
        f"CAST({member} AS VARCHAR) AS member_id FROM {table} WHERE test_name IS NOT NULL AND {' AND '.join(f'{c[side]} IS NOT NULL' for c in leg)}"
        for i, leg in enumerate(_LEG_KEYS))


ORACLE["legacy_classes"] = f"""WITH {PARTNER_CTES},\n{LINK_CTE},
members AS ({_leg_members(0)} UNION ALL {_leg_members(1)}),
sized AS (SELECT *, count(*) FILTER (WHERE side = 'partner') OVER w AS n_partner, count(*) FILTER (WHERE side = 'vendor') OVER w AS n_vendor
  FROM members WINDOW w AS (PARTITION BY leg, class_key))
SELECT * FROM sized WHERE n_partner > 0 AND n_vendor > 0"""

ORACLE["legacy_pair_counts"] = ("WITH pairs AS (" + ORACLE["link_legacy"] + ") SELECT MATCH_TYPE, test_name, count(*) AS pairs FROM pairs GROUP BY ALL")

_SET_KEYS = _DIST + ", GRADE"


def _set_part(report: str, keys: str, where: str, events: bool) -> str:
    own = [k.strip() for k in keys.split(",")]
    cols = ", ".join(k if k in own else f"NULL AS {k}" for k in _SET_KEYS.split(", "))
    measures = "count(*) AS test_count, NULL AS school_count, NULL AS student_count" if events else f"NULL AS test_count, {_COUNTS}"
    return f"SELECT '{report}' AS report, {cols}, {measures} FROM g WHERE {where} GROUP BY {', '.join(own)}"


ORACLE["event_report_set"] = f"WITH {EVENT_VIEW}, g AS (SELECT *, GRADE_ORDINAL AS GRADE FROM ev)\n" + " UNION ALL BY NAME ".join((
    _set_part("total_by_test", _BASE, f"MEASUREMENT_SCALE_BID IN ({_SCALES}) AND GROWTH_EVENT_YN", True), _set_part("by_grade", _BASE + ", GRADE", _FLT1, False),
    _set_part("by_district", _DIST, _FLT1, False), _set_part("by_district_grade", _DIST + ", GRADE", _FLT1, False)))

ORACLE["legacy_tests_by_grade"] = f"""WITH {CHECKED_CTE}
SELECT {sql_clean_grade('GRADE')} AS GRADE, {', '.join(f"count(TRY_CAST(trim({c}) AS DECIMAL(38,0))) AS {c}" for c in LEGACY_GRADES)}
FROM checked WHERE reason IS NULL GROUP BY 1"""
