"""Repair, imputation, flags and the whole cleaning plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric, text
from ..operators import impute, repair
from ..operators import aggregate as agg
from ..plans import insights, state
from ..plans.employees import DEPT_DISPLAY
from ..plans.sales import AUDIT_RULES, CleanConfig, DRAW_KEYS, audit, before_imputation, clean_sales, repair_complete
from ..sources.staging import scratch_path
from .registry import query
from .views import IMPUTED, SALES_COLUMNS, Views, draw, text as quoted, title

_ALL = ", ".join(SALES_COLUMNS)


def union(parts) -> str:
    return "\nUNION ALL ".join(parts)


# --- repair -------------------------------------------------------------------------


@query("realign_shift", f"SELECT {_ALL} FROM c1", ("c1",))
def _(v: Views):
    return repair.realign_shift(v.sales)


@query("realign_shift_keep", "SELECT * FROM shifted", ("shifted",))
def _(v: Views):
    return repair.realign_shift_keep(v.sales)


@query("replace_values", "SELECT Id, Transmission FROM replaced", ("replaced",))
def _(v: Views):
    mapping = {value: "automatic" for value in repair.SHIFTED_VALUES}
    return repair.replace_values(v.sales, "Transmission", mapping).select("Id", "Transmission")


_SPLIT = """SELECT Id, coalesce(mb_make, Make) AS Make, CASE WHEN raw IS NOT NULL THEN mb_body ELSE Body END AS Body
            FROM sales LEFT JOIN mb ON lower(Make) = raw"""


@query("split_by_lookup", _SPLIT, ("sales", "mb"))
def _(v: Views):
    return repair.split_by_lookup(v.sales).select("Id", "Make", "Body")


@query(
    "split_by_table",
    """SELECT s.Id, coalesce(t.first, s.Make) AS Make, coalesce(t.second, s.Body) AS Body
       FROM sales s LEFT JOIN (SELECT DISTINCT lower(p_brand) AS raw, 'Maker ' || substr(p_brand, 7) AS first,
         'Series' AS second FROM part) t ON lower(s.Make) = t.raw""",
)
def _(v: Views):
    brand = F.col("p_brand")
    table = v.table("part").select(
        F.lower(brand).alias("raw"), F.concat(F.lit("Maker "), F.substring(brand, 7, 9)).alias("first"),
        F.lit("Series").alias("second"),
    ).distinct()
    return repair.split_by_lookup(v.sales, table=table).select("Id", "Make", "Body")


@query(
    "split_by_regex",
    """SELECT Id, regexp_replace(Make, ' (truck|tk)$', '', 'i') AS Make,
       CASE WHEN regexp_matches(Make, '(?i) (truck|tk)$') THEN 'Truck' ELSE Body END AS Body FROM sales""",
)
def _(v: Views):
    return repair.split_by_regex(v.sales).select("Id", "Make", "Body")


_MERGE_TEST = """(lower(Model) = 'range' AND contains(lower(Trim), 'rover')) OR lower(Model) = 'rangerover'
                 OR Model IN ('rr', 'RR', 'rrs', 'RRS')"""


@query("merge_fragments", f"SELECT Id, CASE WHEN {_MERGE_TEST} THEN 'Range Rover' ELSE Model END AS Model FROM sales")
def _(v: Views):
    return repair.merge_fragments(v.sales).select("Id", "Model")


@query(
    "merge_fragments_trim",
    """SELECT Id, CASE WHEN lower(Model) = 'range' THEN 'Range Rover' ELSE Model END AS Model,
       CASE WHEN lower(Model) = 'range' THEN trim(regexp_replace(Trim, '^rover\\s*', '', 'i')) ELSE Trim END AS Trim
       FROM sales""",
)
def _(v: Views):
    return repair.merge_fragments_trim(v.sales).select("Id", "Model", "Trim")


def alias_case(col: str, mapping: dict[str, str]) -> str:
    arms = " ".join(f"WHEN {quoted(k)} THEN {quoted(x)}" for k, x in mapping.items())
    return f"CASE lower({col}) {arms} ELSE {col} END"


@query("apply_aliases", f"SELECT Id, {alias_case('Make', repair.MAKE_ALIASES)} AS Make FROM sales")
def _(v: Views):
    return repair.apply_aliases(v.sales, "Make", repair.MAKE_ALIASES).select("Id", "Make")


@query("apply_model_aliases", f"SELECT Id, {alias_case('Model', repair.MODEL_ALIASES)} AS Model FROM sales")
def _(v: Views):
    return repair.apply_aliases(v.sales, "Model", repair.MODEL_ALIASES).select("Id", "Model")


@query(
    "apply_aliases_validated",
    f"""SELECT Id, VIN, CASE WHEN lower(n) = lower(wmi_make) THEN n ELSE Make END AS Make
        FROM (SELECT *, nullif({alias_case('Make', repair.MAKE_ALIASES)}, Make) AS n FROM sales)
        LEFT JOIN wmi ON upper(substr(VIN, 1, 3)) = code""",
    ("sales", "wmi"),
)
def _(v: Views):
    dim = impute.prefix_dimension(v.spark)
    return repair.apply_aliases_validated(v.sales, dim).select("Id", "VIN", "Make")


@query(
    "apply_aliases_table",
    """SELECT Id, coalesce(v, Make) AS Make FROM sales LEFT JOIN
       (SELECT lower(p_brand) AS raw, min(p_brand || ' of ' || p_type) AS v FROM part GROUP BY 1) ON lower(Make) = raw""",
)
def _(v: Views):
    table = v.table("part").selectExpr("p_brand AS raw", "concat(p_brand, ' of ', p_type) AS value")
    return repair.apply_aliases(v.sales, "Make", table).select("Id", "Make")


def own_prefixes(v: Views):
    """A prefix table of the data's own, with many rows for a code."""
    full = v.sales.where("VIN IS NOT NULL AND Make IS NOT NULL AND Body IS NOT NULL")
    return full.selectExpr("substr(VIN, 1, 3) AS code", "lower(Make) AS make", "Body AS body")


@query(
    "impute_from_prefix_table",
    """SELECT Id, coalesce(Make, own.m) AS Make, coalesce(Body, own.b) AS Body
       FROM sales LEFT JOIN own ON Make IS NULL AND upper(substr(VIN, 1, 3)) = code""",
    ("sales", "own"),
)
def _(v: Views):
    return impute.impute_from_prefix(v.sales, own_prefixes(v)).select("Id", "Make", "Body")


@query(
    "clean_sales_validated",
    f"""SELECT Id, coalesce(Make, own.m) AS Make, coalesce(Body, own.b) AS Body FROM (
         SELECT Id, VIN, {title(f"CASE WHEN lower(n) = lower(own.m) THEN n ELSE Make END")} AS Make, {title('Body')} AS Body
         FROM (SELECT *, nullif({alias_case('Make', repair.MAKE_ALIASES)}, Make) AS n FROM c3)
         LEFT JOIN own ON upper(substr(VIN, 1, 3)) = code)
       LEFT JOIN own ON Make IS NULL AND upper(substr(VIN, 1, 3)) = code""",
    ("c3", "own"),
)
def _(v: Views):
    config = CleanConfig(prefixes=own_prefixes(v), validate_aliases=True)
    return before_imputation(v.sales, config).select("Id", "Make", "Body")


@query(
    "repair_complete", "SELECT * FROM repaired_prepared", ("repaired_prepared",),
)
def _(v: Views):
    return repair_complete(v.sales)


@query(
    "title_case",
    f"""SELECT No, {title('First_Name')} AS First_Name, {title('Last_Name')} AS Last_Name,
        {title('Department')} AS Department FROM employees""",
    ("employees",),
)
def _(v: Views):
    return v.employees.select("No", *[text.title_case(c).alias(c) for c in ["First_Name", "Last_Name", "Department"]])


@query(
    "normalise_enum",
    """SELECT Id, CASE lower(trim(Transmission)) WHEN 'auto' THEN 'automatic' WHEN 'man' THEN 'manual'
       ELSE lower(trim(Transmission)) END AS Transmission FROM sales""",
)
def _(v: Views):
    return v.sales.select(
        "Id", text.normalise_enum("Transmission", repair.TRANSMISSION_ALIASES).alias("Transmission")
    )


@query("upper_case", "SELECT Id, upper(State) AS State FROM sales")
def _(v: Views):
    return v.sales.select("Id", F.upper("State").alias("State"))


@query("sentinel_numeric", "SELECT Id, nullif(Odometer, 999999) AS Odometer, nullif(MMR, 999999) AS MMR FROM sales")
def _(v: Views):
    return repair.sentinel_to_null(v.sales, {"Odometer": [999999], "MMR": [999999]}).select("Id", "Odometer", "MMR")


@query(
    "sentinel_string",
    """SELECT Id, CASE WHEN trim(Color) IN ('---', '—', '–', '———') THEN NULL ELSE Color END AS Color,
       CASE WHEN trim(Interior) IN ('---', '—', '–', '———') THEN NULL ELSE Interior END AS Interior FROM sales""",
)
def _(v: Views):
    out = repair.sentinel_to_null(v.sales, {"Color": repair.DASHES, "Interior": repair.DASHES})
    return out.select("Id", "Color", "Interior")


_TEXTS = ["Make", "Model", "Trim", "Body", "Transmission", "VIN", "State", "Color", "Interior", "Seller"]


@query(
    "null_placeholder_all",
    f"SELECT * REPLACE ({', '.join(f'''nullif({c}, '—') AS {c}''' for c in _TEXTS)}) FROM sales",
)
def _(v: Views):
    return repair.null_placeholder_all(v.sales, ["—"])


@query("repair_null_text", "SELECT Id, Make, Trim FROM sales")
def _(v: Views):
    worded = v.sales.select("Id", *[F.coalesce(F.col(c), F.lit("Nan")).alias(c) for c in ["Make", "Trim"]])
    return repair.repair_null_text(worded, ["Make", "Trim"])


@query("to_number", "SELECT Id, try_cast(VIN AS double) AS a, try_cast(substr(Trim, 4) AS double) AS b FROM sales")
def _(v: Views):
    return v.sales.select(
        "Id", numeric.to_number("VIN").alias("a"), numeric.to_number(F.substring("Trim", 4, 9)).alias("b")
    )


@query("to_timestamp", "SELECT Id, CASE WHEN Year % 5 = 0 THEN NULL ELSE SaleDate END AS at FROM sales")
def _(v: Views):
    worded = F.when(F.col("Year") % 5 == 0, "unknown").otherwise(F.col("SaleDate").cast("string"))
    return v.sales.select("Id", numeric.to_ts(worded).alias("at"))


@query("cast_int", "SELECT Id, cast(Year AS int) AS Year FROM sales")
def _(v: Views):
    return v.sales.select("Id", numeric.cast_int(F.col("Year").cast("string")).alias("Year"))


@query(
    "fill_const",
    """SELECT Id, coalesce(Color, 'Unknown') AS Color, coalesce(Interior, 'Unknown') AS Interior,
       coalesce(Trim, 'Base') AS Trim, coalesce(Body, 'Other') AS Body FROM sales""",
)
def _(v: Views):
    fills = {"Color": "Unknown", "Interior": "Unknown", "Trim": "Base", "Body": "Other"}
    return repair.fill_const(v.sales, fills).select("Id", *fills)


@query(
    "fill_median",
    """SELECT Id, coalesce(Odometer, (SELECT median(Odometer) FROM sales)) AS Odometer,
       coalesce(ConditionValue, (SELECT median(ConditionValue) FROM sales)) AS ConditionValue,
       coalesce(MMR, (SELECT median(MMR) FROM sales)) AS MMR FROM sales""",
    digits={"MMR": 6},
)
def _(v: Views):
    cols = ["Odometer", "ConditionValue", "MMR"]
    return repair.fill_median(v.sales.select("Id", *cols), cols)


@query(
    "clip_upper", "SELECT No, CASE WHEN Overtime_Hours > 100 THEN 100 ELSE Overtime_Hours END AS ot FROM employees",
    ("employees",),
)
def _(v: Views):
    return v.employees.select("No", numeric.clip_upper("Overtime_Hours", 100).alias("ot"))


@query("select_columns", "SELECT State, Id, Year FROM sales")
def _(v: Views):
    return repair.select_columns(v.sales, ["State", "Id", "Absent", "Year"])


@query(
    "rename_columns",
    """SELECT Department, count(No) AS Employees, round_even(avg(Monthly_Salary), 0) AS "Avg Monthly Salary ($)",
       sum(Annual_Salary) AS "Total Annual Cost ($)", round_even(avg(Overtime_Hours), 1) AS "Avg OT Hours",
       count(*) FILTER (WHERE Has_Sick_Leave) AS "Sick Leave #", count(*) FILTER (WHERE High_Overtime) AS "High OT #"
       FROM staff GROUP BY 1""",
    ("staff",), digits={"Total Annual Cost ($)": 2},
)
def _(v: Views):
    return repair.rename_columns(agg.dept_summary(v.staff), DEPT_DISPLAY)


@query(
    "yes_no",
    "SELECT No, CASE WHEN High_Overtime THEN 'Yes' WHEN NOT High_Overtime THEN 'No' END AS High_Overtime FROM staff",
    ("staff",),
)
def _(v: Views):
    return v.staff.select("No", text.yes_no("High_Overtime").alias("High_Overtime"))


@query(
    "rescale_dual",
    "SELECT Id, CASE WHEN ConditionValue <= 5 THEN ConditionValue * 10 ELSE ConditionValue END AS ConditionValue FROM sales",
)
def _(v: Views):
    return v.sales.select("Id", numeric.rescale_dual("ConditionValue", 5, 10).alias("ConditionValue"))


@query("ensure_columns", "SELECT Id, Make, false AS _flag_imputed, false AS _flag_non_imputable FROM sales")
def _(v: Views):
    defaults = {"Make": "x", "_flag_imputed": False, "_flag_non_imputable": False}
    return repair.ensure_columns(v.sales.select("Id", "Make"), defaults)


# --- imputation ---------------------------------------------------------------------


@query(
    "snapshot_missing",
    "SELECT Id, " + ", ".join(f"{c} IS NULL AS _was_null_{c}" for c in IMPUTED) + " FROM sales",
)
def _(v: Views):
    return impute.snapshot_missing(v.sales).select("Id", *[impute.WAS_NULL + c for c in IMPUTED])


@query(
    "impute_from_prefix",
    """SELECT Id, coalesce(Make, wmi_make) AS Make, coalesce(Body, wmi_body) AS Body
       FROM sales LEFT JOIN wmi ON Make IS NULL AND upper(substr(VIN, 1, 3)) = code""",
    ("sales", "wmi"),
)
def _(v: Views):
    return impute.impute_from_prefix(v.sales).select("Id", "Make", "Body")


@query("impute_group_mode", "SELECT Id, Color, Interior FROM c8", ("c8",))
def _(v: Views):
    out = impute.impute_group_mode(before_imputation(v.sales), ["Color", "Interior"], ["Make", "Body"])
    return out.select("Id", "Color", "Interior")


def draw_sql(col: str, source: str, keep: str = "s.Id") -> str:
    return f"""SELECT {keep}, coalesce(s.{col}, d.v) AS {col} FROM {source} s LEFT JOIN (
      SELECT Make, Body, Year, {col} AS v, count(*) AS n,
        sum(count(*)) OVER (PARTITION BY Make, Body, Year ORDER BY {col}) AS hi,
        sum(count(*)) OVER (PARTITION BY Make, Body, Year) AS tot
      FROM {source} WHERE {col} IS NOT NULL GROUP BY 1, 2, 3, 4) d
    ON s.{col} IS NULL AND s.Make = d.Make AND s.Body = d.Body AND s.Year = d.Year
      AND {draw(col, 's.Id')} * d.tot >= (d.hi - d.n)::HUGEINT * (1::HUGEINT << 60)
      AND {draw(col, 's.Id')} * d.tot < d.hi::HUGEINT * (1::HUGEINT << 60)"""


@query("impute_conditional", draw_sql("Color", "c6"), ("c6",))
def _(v: Views):
    return impute.impute_conditional(before_imputation(v.sales), "Color", DRAW_KEYS).select("Id", "Color")


@query("label_encode", "SELECT Id, Make, Make_code FROM sales LEFT JOIN (SELECT Make, dense_rank() OVER (ORDER BY Make) - 1 "
       "AS Make_code FROM (SELECT DISTINCT Make FROM sales WHERE Make IS NOT NULL)) USING (Make)")
def _(v: Views):
    return impute.label_encode(v.sales.select("Id", "Make"), "Make")


@query(
    "conditional_distribution",
    """SELECT Make, Body, Year, Color, count(*) AS "count",
       count(*)::double / sum(count(*)) OVER (PARTITION BY Make, Body, Year) AS share FROM c6
       WHERE Make IS NOT NULL AND Body IS NOT NULL AND Year IS NOT NULL AND Color IS NOT NULL GROUP BY 1, 2, 3, 4""",
    ("c6",),
)
def _(v: Views):
    return impute.conditional_distribution(before_imputation(v.sales), "Color", DRAW_KEYS)


_DISTANCE = """sqrt((q.a - t.a) * (q.a - t.a) + (q.b - t.b) * (q.b - t.b) + (q.c - t.c) * (q.c - t.c)
               + (q.d - t.d) * (q.d - t.d))"""
# The five nearest training rows. Those within 300 of the second feature come first; where five of them lie
# within 300 in all, no other row can be nearer, and the others are compared with the whole sample.
_NEAREST = """arg_min(struct_pack(color := t.{col}, dist := {dist}),
               struct_pack(dist := {dist}, id := t.Id), 5)"""


def knn_sql(col: str, source: str, keep: str = "e.Id") -> str:
    nearest = _NEAREST.format(col=col, dist=_DISTANCE)
    return f"""
WITH mk AS (SELECT Make, dense_rank() OVER (ORDER BY Make) - 1 AS mcode
            FROM (SELECT DISTINCT Make FROM {source} WHERE Make IS NOT NULL)),
 bd AS (SELECT Body, dense_rank() OVER (ORDER BY Body) - 1 AS bcode
        FROM (SELECT DISTINCT Body FROM {source} WHERE Body IS NOT NULL)),
 e0 AS (SELECT * FROM {source} LEFT JOIN mk USING (Make) LEFT JOIN bd USING (Body)),
 e AS MATERIALIZED (SELECT * EXCLUDE (mcode, bcode), coalesce(Year, (SELECT median(Year) FROM e0))::double AS a,
        coalesce(Odometer, (SELECT median(Odometer) FROM e0))::double AS b,
        coalesce(mcode, (SELECT median(mcode) FROM e0))::double AS c,
        coalesce(bcode, (SELECT median(bcode) FROM e0))::double AS d FROM e0),
 t AS MATERIALIZED (SELECT * FROM e WHERE {col} IS NOT NULL ORDER BY {draw('sample')}, Id LIMIT 50000),
 q AS MATERIALIZED (SELECT DISTINCT a, b, c, d FROM e WHERE {col} IS NULL),
 one AS MATERIALIZED (SELECT q.a, q.b, q.c, q.d, {nearest} AS xs FROM q JOIN t ON t.b BETWEEN q.b - 300 AND q.b + 300
          GROUP BY 1, 2, 3, 4),
 sure AS MATERIALIZED (SELECT * FROM one WHERE len(xs) = 5 AND list_max(list_transform(xs, lambda x: x.dist)) <= 300),
 rest AS (SELECT q.a, q.b, q.c, q.d, {nearest} AS xs FROM (SELECT * FROM q EXCEPT SELECT a, b, c, d FROM sure) q, t
          GROUP BY 1, 2, 3, 4),
 near AS (SELECT a, b, c, d, unnest(xs) AS x FROM (SELECT * FROM sure UNION ALL SELECT * FROM rest)),
 w AS (SELECT a, b, c, d, x.color AS color, x.dist AS dist, min(x.dist) OVER (PARTITION BY a, b, c, d) AS best FROM near),
 s AS (SELECT a, b, c, d, color, sum(CASE WHEN best = 0 THEN CASE WHEN dist = 0 THEN 1.0e0 ELSE 0.0e0 END
          ELSE 1.0e0 / dist END) AS score FROM w GROUP BY 1, 2, 3, 4, 5),
 p AS (SELECT a, b, c, d, color AS vote FROM s
       QUALIFY row_number() OVER (PARTITION BY a, b, c, d ORDER BY score DESC, color) = 1)
SELECT {keep}, coalesce(e.{col}, vote) AS {col} FROM e LEFT JOIN p USING (a, b, c, d)"""



@query("impute_knn", knn_sql("Color", "c6"), ("c6",))
def _(v: Views):
    return impute.impute_knn(before_imputation(v.sales), "Color").select("Id", "Color")


# --- flags --------------------------------------------------------------------------


@query("flag_imputed", "SELECT Id, _flag_imputed FROM marked", ("marked",))
def _(v: Views):
    return v.cleaned.select("Id", "_flag_imputed")


@query(
    "flag_imputed_post_sentinel",
    "SELECT Id, (" + " OR ".join(
        f"((w_{c}" + {"Color": " OR h_color", "Interior": " OR h_interior", "Odometer": " OR h_odo",
                      "ConditionValue": " OR h_shift"}.get(c, "") + f") AND {c} IS NOT NULL)" for c in IMPUTED
    ) + ") AS _flag_imputed FROM marked",
    ("marked",),
)
def _(v: Views):
    return clean_sales(v.sales, CleanConfig(baseline="post_sentinel")).select("Id", "_flag_imputed")


@query(
    "flag_non_imputable",
    """SELECT Id, (Make IS NULL AND Model IS NULL AND Trim IS NULL AND Body IS NULL
       AND (VIN IS NULL OR trim(VIN) = '')) AS _flag_non_imputable FROM sales""",
)
def _(v: Views):
    return impute.flag_non_imputable(v.sales).select("Id", "_flag_non_imputable")


@query("flag_overlap", "SELECT count(*) FILTER (WHERE _flag_imputed AND _flag_non_imputable) AS overlap FROM marked",
       ("marked",))
def _(v: Views):
    return impute.flag_overlap(v.cleaned)


@query(
    "flag_breakdown",
    """SELECT category, n AS "rows", round_even(n / t * 100, 2) AS share_pct FROM (
         SELECT unnest(['clean', 'imputed', 'non_imputable']) AS category, unnest([
           count(*) FILTER (WHERE NOT _flag_imputed AND NOT _flag_non_imputable),
           count(*) FILTER (WHERE _flag_imputed), count(*) FILTER (WHERE _flag_non_imputable)]) AS n,
         count(*) AS t FROM marked)""",
    ("marked",),
)
def _(v: Views):
    return impute.flag_breakdown(v.cleaned)


@query(
    "quality_label",
    """SELECT Id, CASE WHEN _flag_non_imputable THEN 'Non-imputable' WHEN _flag_imputed THEN 'Imputed' ELSE 'Clean' END
       AS DataQuality FROM marked""",
    ("marked",),
)
def _(v: Views):
    return impute.quality_label(v.cleaned).select("Id", "DataQuality")


_HITS = ["h_shift", "h_split", "h_merge", "h_alias", "h_odo", "h_color", "h_interior", "h_mmr", "h_vin", "g_color",
         "g_interior", "_flag_imputed", "_flag_non_imputable"]


@query(
    "audit_log",
    union(
        f"SELECT {i} AS position, '{step}' AS step, '{rule}' AS rule, count(*) FILTER (WHERE {hit}) AS \"rows\" FROM marked"
        for i, ((step, rule, _), hit) in enumerate(zip(AUDIT_RULES, _HITS))
    ),
    ("marked",),
)
def _(v: Views):
    return audit(v.marked)


@query(
    "filled_counts",
    union(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE w_{c} AND {c} IS NOT NULL) AS filled FROM marked"
        for c in IMPUTED
    ),
    ("marked",),
)
def _(v: Views):
    return impute.filled_counts(v.marked)


@query("clean_sales", "SELECT * FROM cleaned", ("cleaned",))
def _(v: Views):
    return v.cleaned


@query(
    "clean_sales_conditional",
    "WITH ic AS (" + draw_sql("Color", "c6", "s.* EXCLUDE (Color)") + ") "
    + draw_sql("Interior", "ic", "s.Id, s.Color"),
    ("c6",),
)
def _(v: Views):
    return clean_sales(v.sales, CleanConfig(strategy="conditional")).select("Id", "Color", "Interior")


@query(
    "clean_sales_knn",
    "WITH kc AS (" + knn_sql("Color", "c6", "e.Id, e.Make, e.Body, e.Year, e.Odometer, e.Interior") + ") "
    + "SELECT * FROM (" + knn_sql("Interior", "kc", "e.Id, e.Color") + ")",
    ("c6",),
)
def _(v: Views):
    return clean_sales(v.sales, CleanConfig(strategy="knn+conditional")).select("Id", "Color", "Interior")


# --- deliveries ---------------------------------------------------------------------


def _deliveries(v: Views):
    """The sales in two parts, by the last letter of their key."""
    first = F.substring("Id", -1, 1) < "5"
    return v.sales.where(first), v.sales.where(~first)


def _saved_state(v: Views, config: CleanConfig = CleanConfig()):
    """The state of both deliveries, fitted one by one, saved, read again and merged."""
    path = scratch_path(v.spark, "sales-state")
    for i, part in enumerate(_deliveries(v)):
        state.save(state.fit(part, config), f"{path}/{i}")
    return state.merge(*[state.load(v.spark, f"{path}/{i}", config) for i in range(2)])


@query("fit_sales_state", 'SELECT Make, Body, Color, Interior, count(*) AS n FROM c6 GROUP BY ALL', ("c6",))
def _(v: Views):
    return _saved_state(v).tables["groups"]


@query("apply_sales_state", "SELECT * FROM cleaned WHERE right(Id, 1) >= '5'", ("cleaned",))
def _(v: Views):
    return state.apply(_deliveries(v)[1], _saved_state(v))


@query(
    "apply_sales_state_conditional",
    "SELECT * FROM (WITH ic AS (" + draw_sql("Color", "c6", "s.* EXCLUDE (Color)") + ") "
    + draw_sql("Interior", "ic", "s.Id, s.Color") + ") WHERE right(Id, 1) >= '5'",
    ("c6",),
)
def _(v: Views):
    config = CleanConfig(strategy="conditional")
    return state.apply(_deliveries(v)[1], _saved_state(v, config)).select("Id", "Color", "Interior")


# --- text of results ----------------------------------------------------------------


@query(
    "format_kpis",
    """SELECT format('{:,}', count(*)) AS records,
       '$' || format('{:,}', cast(round_even(median(SellingPrice), 0) AS bigint)) AS median_price,
       format('{:,}', cast(round_even(avg(Odometer), 0) AS bigint)) || ' mi' AS avg_odometer,
       format('{:.1f}', round_even(avg(cast(AboveMMR AS int)) * 100, 1)) || '%' AS above_pct,
       format('{:.1f}', round_even(avg(VehicleAge), 1)) || ' yrs' AS avg_age FROM prepared""",
    ("prepared",),
)
def _(v: Views):
    return insights.format_kpis(v.prepared_for("Odometer", "PriceDiff", "VehicleAge", "SellingPrice"))
