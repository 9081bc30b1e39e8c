"""The read-only query surface: a guard over the parse tree, a cost gate, lookups, schema description."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, DateType, DecimalType, MapType, StructType, TimestampNTZType, TimestampType

#: Rows a query returns, bytes it may scan, rows a search shows, and the views.
ROWS, SCAN_BYTES, MATCHES = 200, 200 * 1024 * 1024, 25
VIEWS = ("v_encounter_summary", "v_patient_timeline")
#: The database that serving sessions stand in; nothing is ever put there.
SERVING = "chartloom_serving"
UNNEST = re.compile(r",\s*UNNEST\s*\(\s*([\w.]+)\s*\)\s*(?:AS\s+)?(\w+)", re.IGNORECASE)
#: Functions that a query may call: none reads files, calls the JVM, tells of the session or runs for long.
FUNCTIONS = frozenset("""
abs acos add_months aggregate any any_value array array_agg array_append array_compact array_contains array_distinct array_except array_intersect array_join array_max array_min array_position array_prepend array_remove array_size array_sort array_union arrays_overlap arrays_zip ascii asin atan atan2 avg between bigint bool_and bool_or boolean bround btrim
cardinality cast ceil ceiling char char_length chr coalesce collect_list collect_set concat concat_ws contains corr cos count count_if cume_dist current_date current_timestamp date date_add date_diff date_format date_from_unix_date date_part date_sub date_trunc dateadd datediff datepart day dayname dayofmonth dayofweek dayofyear decimal degrees dense_rank double
element_at endswith equal_null every exists exp explode explode_outer expr extract filter find_in_set first first_value flatten float floor forall format_number format_string get greatest grouping grouping_id hash hex hour if ifnull in initcap inline inline_outer instr int isnan isnotnull isnull
lag last last_day last_value lcase lead least left len length like ilike listagg ln locate log log10 log2 lower lpad ltrim make_date map map_entries map_filter map_keys map_values mask max max_by md5 mean median min min_by minute mod mode month monthname months_between named_struct nanvl negative next_day not now nth_value ntile nullif nullifzero nvl nvl2
octet_length overlay percent_rank percentile percentile_approx pi pmod posexplode posexplode_outer position positive pow power quarter radians rank regexp regexp_count regexp_extract regexp_extract_all regexp_instr regexp_like regexp_replace regexp_substr repeat replace reverse right rint rlike round row_number rpad rtrim
second sentences sequence sha sha1 sha2 shuffle sign signum sin size slice smallint some sort_array soundex split split_part sqrt stack startswith std stddev stddev_pop stddev_samp string string_agg struct substr substring substring_index sum tan timestamp tinyint to_char to_date to_number to_timestamp transform translate trim trunc try_add try_avg try_cast try_divide try_element_at try_multiply try_subtract try_sum try_to_date try_to_number try_to_timestamp typeof
ucase unix_date unix_timestamp upper var_pop var_samp variance weekday weekofyear when year zeroifnull + - * / % = == != <> < > <= >= <=> ! and or
""".split())
#: Parse tree nodes that a read is made of; any other kind is turned down.
RELATIONAL = frozenset("""
Project Filter Aggregate Sort GlobalLimit LocalLimit Limit Offset Join Distinct Union Except Intersect SubqueryAlias UnresolvedSubqueryColumnAliases UnresolvedWith UnresolvedRelation UnresolvedHaving UnresolvedInlineTable OneRowRelation LateralJoin Generate WithWindowDefinition
Window Pivot Unpivot UnresolvedHint Tail RepartitionByExpression AliasedRelation UnresolvedOrdinal LateralSubquery GroupingSets BaseGroupingSets SQLFunctionNode
""".split())


class Refused(ValueError):
    """The query was turned down before anything ran."""


def unnest_rewritten(query: str) -> str:
    """FROM v t, UNNEST(t.a) x -> LATERAL explode, outside string literals."""
    parts = re.split(r"('(?:[^']|'')*')", query)
    return "".join(p if i % 2 else UNNEST.sub(r", LATERAL (SELECT explode(\1) AS \2)", p) for i, p in enumerate(parts))


def items(seq) -> Iterator:
    """Elements of a Scala sequence."""
    return (seq.apply(i) for i in range(seq.size()))


def kind(node) -> str:
    return node.getClass().getSimpleName()


def expressions_of(node) -> Iterator:
    """Every expression of a plan node, at any depth."""
    todo = list(items(node.expressions()))
    while todo:
        e = todo.pop()
        yield e
        todo += items(e.children())


def check_functions(node) -> None:
    for e in expressions_of(node):
        name = kind(e)
        if name == "UnresolvedFunction":
            parts = [p.lower() for p in items(e.nameParts())]
            if len(parts) != 1 or parts[0] not in FUNCTIONS:
                raise Refused(f"the function {'.'.join(parts)} is not permitted")
        elif name in ("CallMethodViaReflection", "TryReflect", "ScalaUDF", "PythonUDF"):
            raise Refused(f"{name} is not permitted")


def check_plan(node, allowed: frozenset[str], found: list[str]) -> None:
    """Walk a parse tree; `allowed` are the relations that names mean at this place.

    A CTE's name means the CTE only behind its definition, and not inside it; there, as
    before it, it means what it means outside.
    """
    name = kind(node)
    if name not in RELATIONAL:
        raise Refused(f"{name} is not permitted; this surface is read-only")
    if name == "UnresolvedRelation":
        parts = [p.lower() for p in items(node.multipartIdentifier())]
        if len(parts) != 1 or parts[0] not in allowed:
            raise Refused(f"`{'.'.join(parts)}` is not a readable view; use one of {', '.join(VIEWS)}")
        found.append(parts[0])
        return
    check_functions(node)
    if name == "UnresolvedWith":
        if node.allowRecursion():
            raise Refused("recursive queries are not permitted")
        inside = allowed
        for pair in items(node.cteRelations()):
            check_plan(pair._2(), inside, found)
            inside = inside | {pair._1().lower()}
        check_plan(node.child(), inside, found)
        return
    for part in (node.children(), node.subqueries()):
        for child in items(part):
            check_plan(child, allowed, found)


def guarded(spark: SparkSession, query: str, views: tuple[str, ...] = VIEWS) -> str:
    """The query, if it is one SELECT over the allowed views and its own CTEs with functions of the list; else Refused.

    Works on the parse tree, so comma joins, nested subqueries, quoted names and paths are
    seen for what they are.
    """
    text = unnest_rewritten(query.strip().rstrip(";").strip())
    if not text:
        raise Refused("empty query")
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Exception as e:  # noqa: BLE001  the JVM's ParseException
        raise Refused(f"not a single readable SELECT: {str(e).splitlines()[0][:200]}") from None
    found: list[str] = []
    check_plan(plan, frozenset(v.lower() for v in views), found)
    if not found:
        raise Refused("the query must read from one of the documented views")
    return text


def scan_bytes(df: DataFrame) -> int:
    """Bytes of the files under the optimised plan's leaves; rows already in memory cost no scan."""
    leaves = list(items(df._jdf.queryExecution().optimizedPlan().collectLeaves()))
    return sum(int(str(leaf.stats().sizeInBytes())) for leaf in leaves if "Relation" in kind(leaf) and "Local" not in kind(leaf))


def converter(of: DataType) -> Callable | None:
    """What makes values of a type fit for JSON; None where they already are."""
    if isinstance(of, StructType):
        fields = [(f.name, converter(f.dataType)) for f in of]
        return lambda row: {n: x if f is None or x is None else f(x) for (n, f), x in zip(fields, row, strict=True)}
    if isinstance(of, ArrayType):
        each = converter(of.elementType)
        return list if each is None else lambda xs: [None if x is None else each(x) for x in xs]
    if isinstance(of, MapType):
        keys, values = converter(of.keyType) or str, converter(of.valueType) or (lambda x: x)
        return lambda m: {str(keys(k)): None if v is None else values(v) for k, v in m.items()}
    if isinstance(of, (DateType, TimestampType, TimestampNTZType)):
        return lambda x: x.isoformat()
    if isinstance(of, DecimalType):
        return float
    if isinstance(of, BinaryType):
        return lambda x: bytes(x).decode("utf-8", "replace")
    return {"time": lambda x: x.isoformat()}.get(of.typeName())


def rows_of(df: DataFrame) -> list[dict]:
    """JSON-safe rows, at any depth, by the schema."""
    convert = converter(df.schema)
    return [convert(r) for r in df.collect()]


def run_sql(session: SparkSession, query: str, most_rows: int = ROWS, most_bytes: int = SCAN_BYTES) -> dict:
    """status ok, refused or error; never raises. The row cap is on the plan, so LIMIT and OFFSET stay as written."""
    try:
        text = guarded(session, query)
    except Refused as e:
        return {"status": "refused", "error": str(e), "sql": query}
    try:
        df = session.sql(text).limit(most_rows)
        size = scan_bytes(df)
        if size > most_bytes:
            return {"status": "refused", "error": f"the query would scan {size} bytes, over {most_bytes}", "sql": text}
        rows = rows_of(df)
        return {"status": "ok", "sql": text, "row_count": len(rows), "rows": rows}
    except PySparkException as e:
        return {"status": "error", "error": str(e).splitlines()[0][:500], "sql": text}
    except Exception as e:  # noqa: BLE001  the surface answers, whatever went wrong
        return {"status": "error", "error": f"{type(e).__name__}: {e}".splitlines()[0][:500], "sql": text}


def serving_session(spark: SparkSession, views: dict[str, DataFrame]) -> SparkSession:
    """A session whose own, empty database is the current one and which sees the views alone by bare names; reading files by path is off."""
    own = spark.newSession()
    own.sql(f"CREATE DATABASE IF NOT EXISTS {SERVING}")
    own.sql(f"USE {SERVING}")
    own.conf.set("spark.sql.runSQLOnFiles", "false")
    for name, df in views.items():
        analysed = df._jdf.queryExecution().analyzed()
        own._jvm.org.apache.spark.sql.classic.Dataset.ofRows(own._jsparkSession, analysed).createOrReplaceTempView(name)
    return own


def holds(column: str, term: str):
    """Substring in any case; NULL holds nothing."""
    return F.like(F.lower(F.coalesce(F.col(column), F.lit(""))), F.concat(F.lit("%"), F.lower(F.lit(term)), F.lit("%")))


def search(rows: DataFrame, term: str, texts: list[str], ident: str, most: int = MATCHES, order: list[str] | None = None, term_of: dict[str, str] | None = None) -> DataFrame:
    """Distinct rows with the term in one of the texts (or another term that is given for it), or as the identifier itself in any case."""
    hit = F.lower(F.col(ident).cast("string")) == F.lower(F.lit(term))
    for c in texts:
        hit = hit | holds(c, (term_of or {}).get(c, term))
    return rows.where(hit).distinct().orderBy(*(order or [ident])).limit(most)


def find_patient(timeline: DataFrame, term: str) -> DataFrame:
    """Who a name or an MRN means: identity, number of visits and their first and last day."""
    shown = ["patient_id", "mrn", "legal_name", "preferred_name", "family_name", "given_name", "date_of_birth", "sex", "encounter_count", "first_seen_date", "last_seen_date"]
    return search(timeline.select(*shown), term, ["legal_name", "preferred_name", "family_name", "given_name"], "mrn", order=["legal_name", "mrn"])


def patient_timeline(timeline: DataFrame, mrn: str) -> DataFrame:
    return timeline.where(F.col("mrn") == mrn).orderBy("encounter_date", "encounter_id").limit(ROWS)


#: Questions with the rules of counting in them: by code, not by wording; patients, not rows; names in lower case.
CANNED = {
    "conditions": "SELECT primary_icd10_code, any_value(primary_diagnosis) AS wording, count(DISTINCT patient_id) AS patients, count(*) AS visits FROM v_encounter_summary WHERE primary_icd10_code IS NOT NULL GROUP BY primary_icd10_code ORDER BY patients DESC, primary_icd10_code",
    "regions": "SELECT body_region_effective, count(DISTINCT patient_id) AS patients, count(*) AS visits FROM v_encounter_summary GROUP BY body_region_effective ORDER BY visits DESC, body_region_effective",
    "imaged_on_anti_inflammatory": "SELECT mrn, encounter_date, anti_inflammatory_on_arrival, anti_inflammatory_prescribed FROM v_encounter_summary WHERE anti_inflammatory_active AND imaging_same_day ORDER BY encounter_date, mrn",
    "patients_with_history": "SELECT count(DISTINCT t.patient_id) AS patients FROM v_patient_timeline t, UNNEST(t.patient_history) h WHERE lower(h.item_text) LIKE '%hypertension%'",
}


def described(schema: StructType, prefix: str = "") -> list[tuple[str, str, str, str]]:
    """(name, type, mode, comment) of every field, nested ones under dotted names."""
    out = []
    for f in schema.fields:
        of, mode = f.dataType, "REQUIRED" if not f.nullable else "NULLABLE"
        if isinstance(of, ArrayType):
            of, mode = of.elementType, "REPEATED"
        out.append((prefix + f.name, "STRUCT" if isinstance(of, StructType) else of.simpleString(), mode, f.metadata.get("comment", "")))
        if isinstance(of, StructType):
            out += described(of, f"{prefix}{f.name}.")
    return out
