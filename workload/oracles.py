"""The same results in DuckDB SQL, written from the query semantics."""

from __future__ import annotations

from reqmill.operators.mapping import PHRASES
from reqmill.schema import BOROUGHS, FIELD_NAMES, FIELDS, LINEAGE, SOURCE_SYSTEMS, STATUSES
from workload import dialects as D
from workload import inputs as I
from workload.registry import BACKFILL_DAYS, BACKFILL_FIRST, CUT, DAY, NOW

ORACLES: dict[str, str] = {}


def _lit(v) -> str:
    return "null" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


def _values(rows) -> str:
    return "values " + ",\n".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)


def _in(values) -> str:
    return "(" + ", ".join(_lit(v) for v in values) + ")"


# --- shared relations -----------------------------------------------------

REQUESTS = """requests as (
  select cast(o_orderkey as varchar) as request_id, o_orderdate as created_at, closed_at,
         c_mktsegment as agency_code, o_orderpriority as complaint_type, r_name as borough,
         o_orderstatus as status, cast(o_orderdate as date) as batch_date
  from orders
  left join (select l_orderkey, max(l_shipdate) as closed_at from lineitem group by l_orderkey) s
    on o_orderkey = l_orderkey
  left join customer on o_custkey = c_custkey
  left join nation on c_nationkey = n_nationkey
  left join region on n_regionkey = r_regionkey)"""

_DERIVED = """created_at::date as created_date, closed_at is not null as is_closed,
  coalesce(closed_at < created_at, false) as has_invalid_timestamps,
  round(case when closed_at >= created_at then date_diff('second', created_at, closed_at) end / 3600.0, 3) as resolution_hours"""

FACT = REQUESTS + f""",
fact as (
  select request_id, created_at, closed_at, agency_code, complaint_type, borough, status,
         batch_date, {_DERIVED}
  from requests)"""

LANDED = """landed as (
  select """ + ",\n".join(f"{sql} as {name}" for name, sql in I.LANDED.items()) + """
  from lineitem join orders on l_orderkey = o_orderkey)"""


def _staged_column(c: str) -> str:
    if c in ("created_at", "closed_at", "resolution_updated_at"):
        return f"try_cast(nullif(trim({c}), '') as timestamp) as {c}"
    if c in ("latitude", "longitude"):
        return f"try_cast(nullif(trim({c}), '') as double) as {c}"
    if c == "request_id":
        return "trim(request_id) as request_id"
    if c == "agency_code":
        return "upper(trim(agency_code)) as agency_code"
    if c in ("borough", "intake_channel"):
        return f"upper(nullif(trim({c}), '')) as {c}"
    return f"nullif(trim({c}), '') as {c}"


STAGED = LANDED + """,
staged as (
  select """ + ",\n".join(_staged_column(c) for c in FIELD_NAMES) + """,
    _source_system as source_system, cast(_batch_date as date) as batch_date, _batch_id as batch_id,
    try_cast(nullif(trim(_ingested_at), '') as timestamp) as ingested_at
  from landed)"""

STAGED_COLUMNS = FIELD_NAMES + ["source_system", "batch_date", "batch_id", "ingested_at"]


def _dedup(name: str, source: str, also: str = "") -> str:
    """The row that is first in the order of newest ingest, newest batch, system, batch,
    for each request, and for each value of another column if there is one."""
    also = also and f"{also}, "
    row = "{" + ", ".join(f"'{c}': {c}" for c in STAGED_COLUMNS) + "}"
    last = "9223372036854775807"
    order = ("{" + f"'i': coalesce(-epoch_us(ingested_at), {last}), 'd': coalesce(-epoch_us(batch_date::timestamp), {last}), "
             "'s': source_system, 'b': batch_id}")
    return f"""{name}_folded as (
  select {also}arg_min({row}, {order}) as newest, count(*) as landings from {source} group by {also}request_id),
{name} as (select {also}unnest(newest), landings > 1 as was_relanded from {name}_folded)"""


FACT_ORDER = """request_id, created_at, closed_at, created_date, agency_code, complaint_type, descriptor,
  location_type, borough, postal_code, city, street_address, latitude, longitude, intake_channel,
  community_board, status, resolution_description, resolution_updated_at, is_closed,
  has_invalid_timestamps, resolution_hours, source_system, batch_date, batch_id, ingested_at,
  was_relanded"""


def _fact(name: str, source: str) -> str:
    return f"""{name} as (select {FACT_ORDER} from (select *, {_DERIVED} from {source}))"""


def _dim(name: str, source: str) -> str:
    """Everything from counts per code and name; the name with the most rows names the code."""
    return f"""{name}_names as (
  select agency_code, agency_name, count(*) as n, count(closed_at) as closed,
         min(created_at) as first_at, max(created_at) as last_at
  from {source} group by all),
{name} as (
  select agency_code,
         coalesce(arg_min(agency_name, {{'few': -n, 'name': agency_name}}) filter (agency_name is not null), 'UNKNOWN') as agency_name,
         sum(n)::bigint as total_requests, sum(closed)::bigint as closed_requests,
         round(sum(closed)::double / sum(n), 4) as closure_rate,
         min(first_at) as first_seen_at, max(last_at) as last_seen_at
  from {name}_names group by agency_code)"""


def _daily(name: str, source: str) -> str:
    """From counted types and counted hours of each day, borough and agency. Fixed values:
    the column names."""
    cell = "created_date, borough, agency_code"
    return f"""{name}_rows as (
  select created_date, coalesce(borough, 'UNSPECIFIED') as borough, agency_code, complaint_type, resolution_hours, is_closed
  from {source}),
{name}_types as (
  select {cell}, count(*) as n, sum(case when is_closed then 1 else 0 end) as closed, count(distinct complaint_type) as kinds
  from {name}_rows group by {cell}),
{name}_ranked as (
  select {cell}, resolution_hours as h, row_number() over (partition by {cell} order by resolution_hours) as place,
         count(*) over (partition by {cell}) as n
  from {name}_rows where resolution_hours is not null),
{name}_hours as (
  select {cell}, sum(h) / count(*) as mean_h, max(h) as most,
         avg(case when place in ((n + 1) // 2, n // 2 + 1) then h end) as middle
  from {name}_ranked group by {cell}),
{name} as (
  select t.created_date, t.borough, t.agency_code, t.n as requests_opened, t.closed::bigint as requests_closed,
         round(t.closed / t.n::double, 4) as closure_rate, round(mean_h, 3) as avg_resolution_hours,
         round(middle, 3) as median_resolution_hours, most as max_resolution_hours, kinds as distinct_complaint_types
  from {name}_types t left join {name}_hours x
    on x.created_date is not distinct from t.created_date and x.borough = t.borough
   and x.agency_code is not distinct from t.agency_code)"""


DEDUPED = STAGED + ",\n" + _dedup("deduped", "staged")
CHAIN = ",\n".join([DEDUPED, _fact("lfact", "deduped"), _dim("dim", "deduped"), _daily("daily", "lfact")])


def add(name: str, ctes: str, body: str) -> None:
    ORACLES[name] = f"with {ctes}\n{body}" if ctes else body


# --- model chain ----------------------------------------------------------

add("daily_sla", FACT + ",\n" + _daily("daily", "fact"), "select * from daily")
add("sketch_months", FACT, """
select cast(date_trunc('month', created_date) as date) as month, coalesce(borough, 'UNSPECIFIED') as borough, count(*) as requests_opened,
       count(*) filter (is_closed) as requests_closed, count(resolution_hours) as timed, true as median_in_bounds, true as types_in_bounds
from fact group by all""")
add("fact_requests", FACT, "select * from fact")
add("stg_typed", STAGED, "select * from staged")
add("dedup_latest", DEDUPED, "select * from deduped")
add("landed_daily_sla", CHAIN, "select * from daily")
add("agency_dim", CHAIN, "select * from dim")
add("code_dim", """coded as (
  select p_brand as agency_code, p_type as agency_name, l_shipdate as created_at,
         case when l_linestatus = 'F' then l_shipdate end as closed_at
  from lineitem join part on l_partkey = p_partkey),
""" + _dim("dim", "coded"), "select * from dim")

_INCREMENT = ",\n".join([
    STAGED, f"early as (select * from staged where batch_date < date '{CUT}')",
    _dedup("early_rows", "early"), _fact("old_fact", "early_rows"),
    _dedup("all_rows", "staged"), _fact("all_fact", "all_rows")])
add("incremental_fact", _INCREMENT + """,
incoming as (select * from all_fact
             where batch_date >= (select coalesce(max(batch_date), date '1900-01-01') from old_fact))""",
    """select * from old_fact where request_id not in (select request_id from incoming)
union all select * from incoming""")
add("changed_requests", _INCREMENT, f"select * from all_fact where batch_date >= date '{CUT}'")
add("upsert_by_key", _INCREMENT + f""",
incoming as (select * from all_fact where batch_date >= date '{CUT}')""",
    """select * from old_fact where request_id not in (select request_id from incoming)
union all select * from incoming""")

_DAYS = f"""days as (
  select cast(date '{BACKFILL_FIRST}' + i::int as date) as day from range({BACKFILL_DAYS}) as r(i)),
seen as (select day, staged.* from days join staged on batch_date <= day),
""" + _dedup("held", "seen", "day")
add("backfill_fact", STAGED + ",\n" + _DAYS + f""",
states as (
  select request_id, source_system, batch_date, batch_id, ingested_at, was_relanded, created_at, closed_at, status,
         min(day) as valid_from, max(day) as until from held group by all)""", f"""
select request_id, batch_id, batch_date, created_at::date as created_date, status, closed_at is not null as is_closed, was_relanded,
       valid_from, case when until < date '{BACKFILL_FIRST}' + {BACKFILL_DAYS - 1} then cast(until + 1 as date) end as valid_to
from states""")
add("backfill_funnel", STAGED + ",\n" + _DAYS + """,
rows_of as (select day, count(*) as n from seen group by day),
held_of as (
  select day, count(*) as n, count(distinct agency_code) as agencies,
         count(distinct (coalesce(created_at::date::varchar, '-'), coalesce(borough, 'UNSPECIFIED'), agency_code)) as cells
  from held group by day)""", """
select day as batch_date, stage, case when stage in ('1_landed', '2_staged') then r.n when stage in ('3_deduped', '4_fact') then a.n
       when stage = '5_daily_mart' then cells else agencies end as rows
from rows_of r join held_of a using (day)
cross join (values ('1_landed'), ('2_staged'), ('3_deduped'), ('4_fact'), ('5_daily_mart'), ('5_agency_dim')) as s(stage)""")

# --- landing --------------------------------------------------------------

_YEARLY = LANDED + f""",
yearly as (select {", ".join(FIELD_NAMES)}, _source_system,
                  substr(_batch_date, 1, 4) || '-01-01' as _batch_date, _batch_id, _ingested_at
           from landed)"""
add("batch_replace", _YEARLY, """select * from yearly
where _batch_date <> '1998-01-01' or _ingested_at < '1998-07-01'""")


def _round_trip() -> str:
    decided = {(s, field): header for s, _, header, _, _, field, _ in D.golden_rows() if field}
    truth = {(s, h): f for s, _, h, f in D.dialect_rows()}
    source_of = {f: c for c, f in D.SOURCE_NAMES.items()}
    columns = []
    for field in FIELD_NAMES:
        whens = []
        for s in D.HEADERS:
            header = decided.get((s, field))
            if header is not None:
                whens.append(f"when '{s}' then {source_of[truth[(s, header)]]}")
        columns.append(f"case system {' '.join(whens)} else null end as {field}")
    shards = ", ".join(f"'{s}'" for s in D.HEADERS)
    source = ", ".join(f"{sql} as {name}" for name, sql in I.SOURCE.items())
    return f"""with source as (select {source} from orders),
dealt as (select *, ([{shards}])[1 + cast((row_number() over (order by unique_key) - 1) % 4 as int)] as system
          from source)
select {", ".join(columns)}, system as _source_system, '{DAY}' as _batch_date, 'b1' as _batch_id,
       '2024-01-16T00:00:00+00:00' as _ingested_at
from dealt"""


ORACLES["files_round_trip"] = _round_trip()


def _stamped(mapped: dict[str, str], source: str, system: str) -> str:
    cols = [f"cast({mapped[f]} as varchar) as {f}" if f in mapped else f"cast(null as varchar) as {f}"
            for f in FIELD_NAMES]
    stamps = [f"'{v}' as {c}" for c, v in
              zip(LINEAGE, (system, str(DAY), "b1", "2024-01-16T00:00:00+00:00"))]
    return f"select {', '.join(cols + stamps)} from {source}"


ORACLES["rename_union_stamp"] = _stamped(
    {"request_id": "c_custkey", "agency_name": "c_name", "agency_code": "c_mktsegment"}, "customer", "crm"
) + "\nunion all\n" + _stamped(
    {"request_id": "s_suppkey", "agency_name": "s_name", "city": "s_nationkey"}, "supplier", "erp")

_DAY_FILTER = f"ts >= timestamp '{DAY}' and ts < timestamp '{DAY}' + interval 1 day"
add("day_slice", "", f"select event_id, ts, user_id, event_type from events where {_DAY_FILTER}")
add("day_rows", "", f"select event_id, ts from events where {_DAY_FILTER}")
add("newest_n", "", "select event_id, ts, event_type from events order by ts desc, event_id limit 500")
add("batch_bounds", "source as (select " + I.SOURCE["closed_date"] + " as closed_date from orders)",
    """select max(closed_date) as newest_created_at, min(closed_date) as oldest_created_at
from source where closed_date <> ''""")
_SYSTEMS = "[" + ", ".join(f"'{s}'" for s in SOURCE_SYSTEMS) + "]"
add("round_robin_split", """indexed as (
  select event_id, event_type, row_number() over (order by event_type, event_id) - 1 as row_index from events)""",
    f"select *, ({_SYSTEMS})[1 + cast(row_index % 4 as int)] as source_system from indexed")
add("batch_manifest", f"""indexed as (
  select ({_SYSTEMS})[1 + cast((row_number() over (order by event_id) - 1) % 4 as int)] as source_system from events)""",
    f"""select '{DAY}' as batch_date, (select count(*) from events) as total_rows, source_system,
  count(*) as rows, cast(list_position({_SYSTEMS}, source_system) + 1 as int) as columns
from indexed group by source_system""")
add("sample_values", """head as (
  select event_id as k, cast(event_id as varchar) as event_id, event_type,
         case when value > 10 then '' else props end as props
  from events order by k limit 20),
cells as (
  select k, 'event_id' as source_column, event_id as v from head
  union all select k, 'event_type', event_type from head
  union all select k, 'props', props from head),
kept as (select *, row_number() over (partition by source_column order by k) as n
         from cells where trim(v) <> '')""",
    """select c.source_column, coalesce(string_agg(v, '|' order by k), '') as samples
from (values ('event_id'), ('event_type'), ('props')) c(source_column)
left join kept on kept.source_column = c.source_column and n <= 5 group by c.source_column""")

# --- stored tables --------------------------------------------------------

add("table_row_counts", "", """select 'orders' as relation, count(*) as rows from orders
union all select 'lineitem', count(*) from lineitem
union all select 'customer', count(*) from customer
union all select 'no_such_table', -1""")
add("export_counts", FACT, """select 'fact' as table, count(*) as rows from fact
union all select 'complaints', count(distinct complaint_type) from fact""")
add("snapshot_table", FACT, "select status, count(*) as requests from fact group by status")
add("live_table", FACT, "select borough, count(*) as requests from fact group by borough")
add("schema_tables", FACT, """select 'staging' as schema, count(*) as rows from fact
union all select 'analytics', count(distinct status) from fact union all select 'raw', -1""")
add("empty_days", """d as (select cast(date '1998-07-20' + (30 * i)::int as date) as day from range(6) as r(i))""",
    """select day, not exists (select 1 from orders where cast(o_orderdate as date) = day) as refused from d""")
add("latest_batch_rows", FACT, """select request_id, agency_code, batch_date from fact
where batch_date = (select max(batch_date) from fact)""")

# --- scalars --------------------------------------------------------------

add("normalise", """texts as (
  select url as header from pages
  union all select c_name from customer
  union all select array_to_string(list_transform(string_split(p_name, ' '),
      lambda w: upper(w[1]) || lower(w[2:])), ' ') || ' ' || p_brand || lower(p_type)
      || upper(p_type[1]) || lower(p_type[2:]) from part
  union all select text from conversations)""",
    r"""select header, trim(regexp_replace(lower(regexp_replace(header, '([a-z0-9])([A-Z])', '\1_\2', 'g')),
  '[^a-z0-9]+', '_', 'g'), '_') as normalized from texts""")
add("scalar_functions", "", """select o_orderkey,
  strftime(o_orderdate, '%Y-%m-%d') as day, strftime(o_orderdate, '%Y-%m-%d %H:%M') as minute,
  starts_with(o_orderpriority, '4') as is_fourth, o_orderpriority as third, o_orderpriority as whole,
  cast(o_orderdate as date) + 1 as day_after, round(o_totalprice / 7, 3) as sevenths,
  round(o_custkey * 1.0 / nullif(o_orderkey, 0), 4) as key_ratio
from orders""")
add("batch_windows", "days as (select distinct cast(ts as date) as day from events)",
    "select day, day + cast(i as int) as batch_date from days, range(3) r(i)")

# --- header resolution ----------------------------------------------------

_ORDER = "[" + ", ".join(f"'{s}'" for s in D.HEADERS) + "]"


def _feeds(name: str, rows, columns: str) -> str:
    return f"""{name} as (
  select s_name as source_system, g.* from supplier
  join ({_values(rows)}) g({columns}) on g.dialect = ({_ORDER})[1 + s_suppkey % 4])"""


GOLD = _feeds("gold", D.golden_rows(),
              "dialect, ordinal, source_column, expected, method, canonical_field, confidence")

# Outcome of the headers a proposal touches: system, header, method, field,
# confidence, outcome.
_PROPOSED = {
    ("legacy_crm", "INTK_SRC"): ("llm", "intake_channel", 0.93, "accepted"),
    ("legacy_crm", "DESCR"): ("unmapped", None, 0.7692, "low"),
    ("legacy_crm", "LOC_TYP"): ("unmapped", None, 0.7059, "invalid"),
    ("legacy_crm", "ROW_CHECKSUM"): ("llm", None, 0.97, "declined"),
    ("legacy_crm", "RES_TXT"): ("unmapped", None, 0.85, "accepted"),
    ("vendor_csv", "Issue Detail"): ("llm", "descriptor", 0.88, "accepted"),
    ("vendor_csv", "Export Timestamp"): ("unmapped", None, 0.99, "accepted"),
    ("mobile_app_v2", "assignedAgencyLabel"): ("llm", "agency_name", 0.8, "accepted"),
    ("mobile_app_v2", "siteKind"): ("unmapped", None, 0.5846, "low"),
}
PROPOSED = _feeds(
    "proposed", [(s, i, h, *_PROPOSED.get((s, h), (m, f, c, None)))
                 for s, i, h, _, m, f, c in D.golden_rows()],
    "dialect, ordinal, source_column, method, canonical_field, confidence, proposal_outcome")

_NORM = (r"trim(regexp_replace(lower(regexp_replace({0}, '([a-z0-9])([A-Z])', '\1_\2', 'g')), "
         r"'[^a-z0-9]+', '_', 'g'), '_')")
PHRASE_TABLE = "phrases(i, phrase, field) as (" + _values(
    [(i, p, f) for i, (p, f) in enumerate(PHRASES)]) + ")"
add("map_exact", GOLD + ",\n" + PHRASE_TABLE + f""",
names as (select {_NORM.format("phrase")} as norm,
                 arg_min(field, (case when phrase = replace(field, '_', ' ') then 0 else 1 end) * 1000 + i) as field
          from phrases group by 1)""",
    f"""select source_system, source_column, {_NORM.format("source_column")} as norm, field as exact_field
from gold left join names on names.norm = {_NORM.format("source_column")}""")
add("map_decisions", GOLD, """select source_system, ordinal, source_column, canonical_field, method,
  cast(confidence as double) as confidence from gold""")
add("map_proposals", PROPOSED, """select source_system, ordinal, source_column, canonical_field, method,
  cast(confidence as double) as confidence, proposal_outcome from proposed""")
add("map_proposal_counts", PROPOSED, "select source_system, " + ", ".join(
    f"count(*) filter (where proposal_outcome = '{o}') as proposals_{o}"
    for o in ("accepted", "declined", "invalid", "low")) + " from proposed group by source_system")

_BY_METHOD = ", ".join(f"count(*) filter (where method = '{m}') as {m}"
                       for m in ("exact", "llm", "fuzzy", "override", "unmapped"))
STATS = GOLD + f""",
stats as (
  select source_system, count(*) as columns_total, count(canonical_field) as columns_mapped, {_BY_METHOD},
    count(*) filter (where method <> 'override') as auto_columns,
    count(canonical_field) filter (where method <> 'override') as auto_mapped,
    round(count(canonical_field) filter (where method <> 'override') * 1.0
          / count(*) filter (where method <> 'override'), 4) as auto_match_rate,
    round(count(*) filter (where method = 'fuzzy') * 1.0 / count(canonical_field), 4) as fallback_rate,
    round(avg(cast(confidence as double)) filter (where canonical_field is not null), 4) as mean_confidence,
    '' as missing_required
  from gold group by source_system)"""
add("map_stats", STATS, "select * from stats")
add("summary_round_trip", STATS, "select source_system, columns_total, auto_match_rate from stats")
add("map_rollup", STATS, """select count(*) as source_systems,
  cast(sum(columns_total) as bigint) as columns_total, cast(sum(columns_mapped) as bigint) as columns_mapped,
  cast(sum(auto_mapped) as bigint) as columns_auto_mapped,
  round(sum(auto_mapped) * 1.0 / sum(auto_columns), 4) as auto_match_rate,
  cast(sum(exact) as bigint) as exact, cast(sum(llm) as bigint) as llm, cast(sum(fuzzy) as bigint) as fuzzy,
  cast(sum(override) as bigint) as override, cast(sum(unmapped) as bigint) as unmapped,
  round(sum(fuzzy) * 1.0 / sum(columns_mapped), 4) as fallback_rate,
  bool_or(llm > 0) as llm_used, count(*) filter (where missing_required <> '') as systems_missing_required
from stats""")
_ACCURACY = """count(*) as columns, count(expected) as should_map,
  count(*) filter (where expected = canonical_field) as correct,
  count(*) filter (where expected <> canonical_field) as mis_mapped,
  count(*) filter (where expected is not null and canonical_field is null) as missed,
  count(*) filter (where expected is null) as operational,
  count(*) filter (where expected is null and canonical_field is null) as declined,
  count(*) filter (where method = 'override') as overrides,
  round(count(*) filter (where expected = canonical_field) * 1.0 / count(expected), 4) as recall,
  round(count(*) filter (where expected = canonical_field) * 1.0
        / count(*) filter (where expected is not null and canonical_field is not null), 4) as precision"""
add("map_accuracy", GOLD, f"""select source_system, {_ACCURACY} from gold group by source_system
union all select 'TOTAL', {_ACCURACY} from gold""")
add("map_histogram", GOLD, """select b.bucket, cast(b.position as int) as position, count(g.source_column) as columns
from (values ('1.00 (exact/override)', 0), ('0.90-0.99', 1), ('0.82-0.89', 2),
             ('below threshold (unmapped)', 3)) b(bucket, position)
left join (select *, case when canonical_field is null then 3 when confidence >= 1 then 0
                          when confidence >= 0.9 then 1 else 2 end as p from gold) g on g.p = b.position
group by b.bucket, b.position""")
add("map_methods", GOLD, """select m.method, cast(m.position as int) as position, m.kind, count(g.source_column) as columns
from (values ('exact', 0, 'resolved'), ('llm', 1, 'resolved'), ('fuzzy', 2, 'resolved'),
             ('override', 3, 'resolved'), ('unmapped', 4, 'declined')) m(method, position, kind)
left join gold g on g.method = m.method group by all""")
_RATE = """cast(count(canonical_field) filter (where method <> 'override') as double)
  / count(*) filter (where method <> 'override')"""
add("map_live_stats", GOLD, f"select count(*) as columns, {_RATE} as auto_match_rate, {_BY_METHOD} from gold")
add("map_missing_required", _feeds("missing", [
    ("legacy_crm", "request_id"), ("vendor_csv", "complaint_type"), ("mobile_app_v2", "complaint_type")],
    "dialect, canonical_field"), "select source_system, canonical_field from missing")
add("map_errors", _feeds("missing", [
    ("legacy_crm", "request_id"), ("vendor_csv", "complaint_type"), ("mobile_app_v2", "complaint_type")],
    "dialect, canonical_field"), """select source_system,
  'required canonical fields left unmapped: ' || canonical_field as error from missing""")
add("map_flatten", GOLD, """select source_system, source_column, canonical_field, method,
  cast(confidence as double) as confidence from gold""")
add("decision_log", GOLD, """select method, count(*) as columns, 2 * count(*) as logged
from gold group by method""")
_UNITS = "sum(round(confidence * 10000))::bigint as units"
add("log_shapes", GOLD, f"""select true as readable, 0 as shape, method, count(*) as lines, count(canonical_field) as mapped, {_UNITS}
from gold group by method
union all select true, 1, method, count(*), count(canonical_field), {_UNITS} from gold where source_column <> 'city' group by method
union all select false, -1, '-', count(*), 0, null from gold where source_column = 'city' having count(*) > 0""")
_INITCAP = "array_to_string(list_transform(string_split({0}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
_PART_HEADER = I.PART_HEADER.replace("initcap(p_name)", _INITCAP.format("p_name"))
PARTS = f"""parts as (
  select distinct p_brand as source_system, {_PART_HEADER} as source_column, {I.PART_FIELD} as canonical_field
  from part)"""
add("header_pivot", GOLD + ",\n" + PARTS + """,
rows as (select dialect as s, source_column as h, expected as f from gold
         union all select 'parts', source_column, canonical_field from parts)""", "select f as canonical_field, " + ", ".join(
    f"min(h) filter (s = '{s}') as {s}" for s in [*SOURCE_SYSTEMS, "parts"]) + " from rows where f is not null group by f")
add("known_headers", GOLD + ",\n" + PARTS, """select source_column as header from gold
union select source_column from parts""")
_ODD = "case when length(source_system) % 2 = 0 then 'nowhere' end"
add("invalid_overrides", _feeds("o", D.OVERRIDES, "dialect, source_column, canonical_field"), f"""select source_system, source_column,
  {_ODD} as canonical_field from o where canonical_field is null and {_ODD} is not null""")
add("rollup_with_rows", PROPOSED + """,
lines as (select count(*) as rows_read, count(*) filter (l_linestatus = 'F') as rows_loaded
          from lineitem join supplier on l_suppkey = s_suppkey)""", """select count(distinct source_system) as source_systems,
  count(*) filter (method = 'override') as overrides_applied, count(*) filter (proposal_outcome = 'invalid') as proposals_invalid,
  count(*) filter (proposal_outcome = 'low') as proposals_low, any_value(rows_read) as rows_read,
  any_value(rows_loaded) as rows_loaded, count(distinct source_system)::int as entries
from proposed, lines""")
add("schema_fields", LANDED, "\nunion all ".join(
    f"select '{f.name}' as field, '{f.dtype}' as type, {str(f.required).lower()} as required, {i} as ordinal, "
    f"count(nullif(trim({f.name}), '')) as filled from landed" for i, f in enumerate(FIELDS)))
add("override_listing", _feeds("o", D.OVERRIDES, "dialect, source_column, canonical_field"),
    "select source_system, source_column, canonical_field from o")

# --- checks ---------------------------------------------------------------


def _suite() -> str:
    """Failures of each of the 44 checks, one aggregate per check."""
    later = f"timestamp '{NOW}' + interval 24 hour"
    rows: list[tuple[str, str, str, str, str]] = []

    def put(kind, model, relation, column, severity, failures, name=None):
        rows.append((name or f"{kind}_{model}_{column}", kind, model, severity, f"({failures})"))

    def bad(relation, condition):
        return f"select count(*) from {relation} where {condition}"

    relations = {"raw": "landed", "staged": "staged", "dim": "dim", "fact": "lfact", "daily": "daily"}
    not_null = {
        "raw": ["request_id", "_batch_id"],
        "staged": ["request_id", "created_at", "agency_code", "complaint_type", "source_system", "batch_date"],
        "dim": ["agency_code", "agency_name", "total_requests"],
        "fact": ["request_id", "created_at", "created_date", "agency_code", "complaint_type", "is_closed",
                 "has_invalid_timestamps", "source_system", "batch_date"],
        "daily": ["created_date", "borough", "agency_code", "requests_opened"]}
    for model, columns in not_null.items():
        for c in columns:
            put("not_null", model, relations[model], c, "error", bad(relations[model], f"{c} is null"))
    for model in ("staged", "fact"):
        for c in ("created_at", "closed_at"):
            put("not_in_future", model, relations[model], c, "error",
                bad(relations[model], f"{c} is not null and {c} > {later}"))
    for model, c, low, high in (("staged", "latitude", 40.4, 41.0), ("staged", "longitude", -74.3, -73.6),
                                ("dim", "closure_rate", 0, 1), ("fact", "resolution_hours", 0, 200000),
                                ("daily", "closure_rate", 0, 1)):
        put("within_range", model, relations[model], c, "error",
            bad(relations[model], f"{c} is not null and ({c} < {low} or {c} > {high})"))
    for model, c, values, severity in (("raw", "_source_system", SOURCE_SYSTEMS, "error"),
                                       ("staged", "borough", BOROUGHS, "warn"),
                                       ("fact", "status", STATUSES, "warn"),
                                       ("fact", "source_system", SOURCE_SYSTEMS, "error")):
        put("accepted_values", model, relations[model], c, severity,
            f"select count(distinct {c}) from {relations[model]} where {c} not in {_in(values)}")
    for model, c in (("dim", "agency_code"), ("fact", "request_id")):
        put("unique", model, relations[model], c, "error",
            f"select count(*) from (select {c} from {relations[model]} where {c} is not null "
            f"group by {c} having count(*) > 1)")
    for model in ("fact", "daily"):
        put("relationships", model, relations[model], "agency_code", "error",
            bad(relations[model], "agency_code is not null and agency_code not in "
                                  "(select agency_code from dim where agency_code is not null)"))
    put("singular", "daily", "", "", "error",
        "select ((select count(*) from lfact) <> coalesce(sum(requests_opened), 0))::bigint from daily",
        "assert_agg_matches_fact_row_count")
    put("singular", "fact", "", "", "error",
        "select count(*) filter (not (has_invalid_timestamps and resolution_hours is null)) from lfact "
        "where closed_at < created_at", "assert_closed_after_created")
    put("singular", "fact", "", "", "warn",
        "select coalesce(bool_or(has_invalid_timestamps), false)::bigint from lfact",
        "assert_timestamp_anomaly_rate")
    union = "\nunion all ".join(
        f"select '{t}' as test, '{k}' as type, '{m}' as model, '{s}' as severity, {n} as failures"
        for t, k, m, s, n in rows)
    return CHAIN + f""",
counted as ({union}),
results as (select *, case when failures = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status
            from counted)"""


SUITE = _suite()
add("check_suite", SUITE, "select * from results")
_TOTALS = """count(*) as tests_total, count(*) filter (where status = 'pass') as tests_passed,
  count(*) filter (where status = 'fail') as tests_failed, count(*) filter (where status = 'warn') as tests_warned,
  count(*) filter (where status = 'error') as tests_errored,
  round(count(*) filter (where status = 'pass') * 1.0 / count(*), 4) as test_pass_rate"""
add("check_summary", SUITE, f"""select {_TOTALS},
  string_agg(test, ',' order by test) filter (where status <> 'pass') as failing_tests from results""")
add("gate_outcome", SUITE + f""",
totals as (select {_TOTALS}, string_agg(test, ',' order by test) filter (where status <> 'pass') as failing_tests from results)""",
    """select 'all' as model, tests_failed + tests_errored > 0 as stopped, case when tests_failed + tests_errored > 0
  then tests_failed || ' failed, ' || tests_errored || ' errored: ' || failing_tests else '' end as message from totals""")
add("failing_checks", SUITE, """select test as "check", failures as failing_rows from results where status <> 'pass'""")
add("test_outcomes", SUITE, "select type, status, count(*) as tests from results group by type, status")
add("stage_funnel", CHAIN, "\nunion all ".join(
    f"select '{stage}' as stage, (select count(*) from {rel}) as rows" for stage, rel in (
        ("1_landed", "landed"), ("2_staged", "staged"), ("3_deduped", "deduped"), ("4_fact", "lfact"),
        ("5_daily_mart", "daily"), ("5_agency_dim", "dim"))) + "\nunion all select '6_absent', -1")
add("check_not_null", STAGED, "select request_id, batch_id, complaint_type from staged where complaint_type is null")
add("check_unique", "", """select l_orderkey as unique_field, count(*) as n_records from lineitem
group by l_orderkey having count(*) > 1""")
add("check_accepted", STAGED, f"""select borough as value_field, count(*) as n_records from staged
where borough not in {_in(BOROUGHS)} group by borough""")
add("check_relationships", "", """select l_orderkey as from_field, count(*) as n_records from lineitem
where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus <> 'O')
group by l_orderkey""")
add("check_future", "", f"""select o_orderkey, o_orderdate as offending_value from orders
where o_orderdate > timestamp '{NOW}' + interval 24 hour""")
add("check_range", "", """select c_custkey, c_acctbal as offending_value from customer
where c_acctbal < 0 or c_acctbal > 9000""")
add("check_reconcile", FACT, """select * from (select (select count(*) from fact) as fact_rows,
  (select count(*) from fact where created_date <> date '1998-10-03') as agg_rows) where fact_rows <> agg_rows""")
add("check_quarantine", FACT, """select request_id, created_at, closed_at, resolution_hours,
  has_invalid_timestamps and status <> 'P' as has_invalid_timestamps
from fact where closed_at < created_at and status = 'P'""")
add("check_anomaly", FACT, "select count(*) filter (has_invalid_timestamps) as anomalous_requests from fact")

_LATER = f"timestamp '{NOW}' + interval 24 hour"
_TYPED = """typed as (select *, try_cast(nullif(trim(created_at), '') as timestamp) as c,
  try_cast(nullif(trim(closed_at), '') as timestamp) as z,
  try_cast(latitude as double) as lat, try_cast(longitude as double) as lon from landed)"""
add("row_checks", LANDED + ",\n" + _TYPED + ",\nfound as (" + "\nunion all ".join(
    [f"select 'not_null: {c}' as \"check\", 'not_null_{c}' as mirrors, "
     f"(select count(*) from typed where {c} is null or {c} = '') as failures, '' as detail"
     for c in ("request_id", "created_at", "agency_code", "complaint_type")]
    + ["select 'unique: request_id', 'unique_fct_request_id', "
       "(select count(*) - count(distinct request_id) from typed), ''"]
    + [f"select 'not_in_future: {c}', 'not_in_future_{c}', (select count(*) from typed where {t} > {_LATER}), ''"
       for c, t in (("created_at", "c"), ("closed_at", "z"))]
    + [f"select 'within_range: {c}', 'within_range_{c}', "
       f"(select count(*) from typed where {t} < {lo} or {t} > {hi}), 'expected {lo} to {hi}'"
       for c, t, lo, hi in (("latitude", "lat", 40.4, 41.0), ("longitude", "lon", -74.3, -73.6))]
    + [f"select 'accepted_values: borough', 'accepted_values_borough', "
       f"(select count(*) from typed where trim(upper(borough)) not in {_in([*BOROUGHS, ''])}), ''"]
    + ["select 'closed_at is never before created_at', 'assert_closed_after_created', "
       "(select count(*) from typed where z < c), "
       "(select count(*) from typed where z < c) || ' row(s) quarantined: flagged, without a duration'"]) + ")",
    """select "check", mirrors, failures, failures = 0 or mirrors = 'assert_closed_after_created' as passed, detail
from found""")

# --- reports --------------------------------------------------------------

_VOLUME = """select created_date, borough, cast(sum(requests_opened) as bigint) as requests_opened,
  cast(sum(requests_closed) as bigint) as requests_closed from daily group by created_date, borough"""
add("daily_volume", FACT + ",\n" + _daily("daily", "fact"), _VOLUME)
add("daily_volume_first_boroughs", CHAIN + f", volume as ({_VOLUME})", """select * from volume
where borough in (select distinct borough from volume where borough <> 'UNSPECIFIED' order by borough limit 2)""")
add("agencies_by_volume", CHAIN, "select * from dim order by total_requests desc")
add("top_complaints", FACT + """,
kinds as (select complaint_type, count(*) as requests, round(mean(resolution_hours), 2) as avg_resolution_hours
          from fact group by all)""", """from kinds
qualify row_number() over (order by requests desc, complaint_type) <= 15""")
add("newest_facts", FACT, """select request_id, created_at, closed_at, agency_code, complaint_type, borough,
  status, resolution_hours, has_invalid_timestamps, batch_date
from fact order by created_at desc, request_id limit 8000""")
add("anomalies", FACT, """select request_id, agency_code, complaint_type, created_at, closed_at, borough
from fact where has_invalid_timestamps order by created_at""")
add("type_mix", FACT, "select complaint_type, count(*) as requests from fact group by complaint_type")
add("borough_mix", CHAIN, """select coalesce(borough, 'UNSPECIFIED') as borough, count(*) as requests
from lfact group by 1""")
add("batch_date_list", LANDED, "select distinct _batch_date from landed")
add("headline", SUITE + ",\n" + FACT + ",\n" + GOLD,
    f"""select (select count(*) from fact) as rows_loaded, (select count(distinct batch_date) from fact) as batches,
  (select count(*) from gold) as mapping_decisions, (select {_RATE} from gold) as auto_match_rate, tiers.*,
  tests_total, tests_failed, test_pass_rate from (select {_TOTALS} from results), (select {_BY_METHOD} from gold) tiers""")
add("run_report", SUITE + ",\n" + GOLD, f"""select '{DAY}' as batch_date, 'b1' as batch_id,
  (select count(*) from landed) as landed, (select count(*) from lfact) as fact, tests_total, tests_passed,
  (select count(*) from gold) as columns_total, (select round({_RATE}, 4) from gold) as auto_match_rate,
  (select count(*) from gold where canonical_field is null) as unmapped, (select count(*) from gold) as decisions,
  (select count(*) from gold where method = 'exact') as exact, (tests_total - tests_passed)::int as checks_not_passing
from (select {_TOTALS} from results)""")

_LIVE = LANDED + """,
live as (select * replace (
    try_cast(nullif(trim(created_at), '') as timestamp) as created_at,
    try_cast(nullif(trim(closed_at), '') as timestamp) as closed_at,
    coalesce(nullif(upper(borough), ''), 'UNSPECIFIED') as borough) from landed)"""
add("live_agencies", _LIVE, """select agency_code, count(request_id) as total_requests,
  count(closed_at) as closed_requests, round(count(closed_at) * 1.0 / count(request_id), 4) as closure_rate
from live group by agency_code""")
add("live_complaints", _LIVE, "select complaint_type, count(*) as requests from live group by complaint_type")
add("live_boroughs", _LIVE, "select borough, count(*) as requests from live group by borough")
add("live_fact", _LIVE, """select request_id, _batch_id, created_at, closed_at, borough,
  coalesce(closed_at < created_at, false) as has_invalid_timestamps,
  round(case when not coalesce(closed_at < created_at, false)
        then date_diff('microsecond', created_at, closed_at) / 1000000.0 / 3600.0 end, 6) as resolution_hours
from live""")


# --- similarity -----------------------------------------------------------


def _fuzzy(probes: str) -> str:
    """Every probe against every phrase, by the plain formulas.

    The common subsequence is counted bit-parallel: one bit per position of the
    shorter string, one step per character of the other.
    """
    return f"""with {PHRASE_TABLE},
probes as ({probes}),
split as (select p, i, phrase as q, field, list_sort(string_split(p, ' ')) as pt,
                 list_sort(string_split(phrase, ' ')) as qt
          from (select distinct p from probes), phrases),
sets as (select *, list_sort(list_distinct(pt)) as pu, list_sort(list_distinct(qt)) as qu from split),
parts as (select p, i, q, field, array_to_string(pt, ' ') as ps, array_to_string(qt, ' ') as qs,
                 array_to_string(pu, ' ') as pd, array_to_string(qu, ' ') as qd,
                 array_to_string(list_filter(pu, lambda x: list_contains(qu, x)), ' ') as common,
                 array_to_string(list_filter(pu, lambda x: not list_contains(qu, x)), ' ') as only_p,
                 array_to_string(list_filter(qu, lambda x: not list_contains(pu, x)), ' ') as only_q
          from sets),
pairs as (select *, trim(common || ' ' || only_p) as with_p, trim(common || ' ' || only_q) as with_q,
                 greatest(length(p), length(q)) / cast(least(length(p), length(q)) as double) as spread
          from parts),
whole as (select p as a, q as b from pairs union select ps, qs from pairs union select with_p, with_q from pairs
          union select common, with_p from pairs where common <> ''
          union select common, with_q from pairs where common <> ''),
searches as (select p as a, q as b from pairs union select ps, qs from pairs where common = ''
             union select pd, qd from pairs where common = ''),
sided as (select a, b, a as short, b as long from searches where length(a) <= length(b)
          union select a, b, b, a from searches where length(b) <= length(a)),
windows as (select a, b, short, substr(long, greatest(start, 0) + 1,
                   cast(length(short) + least(start, 0) as bigint)) as w
            from (select *, unnest(range(1 - length(short), length(long))) as start from sided)),
jobs as (select distinct case when length(a) <= length(b) then a else b end as s,
                         case when length(a) <= length(b) then b else a end as t
         from (select a, b from whole union select short, w from windows)),
scored as (select s, t, case when length(s) + length(t) = 0 then 100.0 else
    200.0 * (length(s) - bit_count(list_reduce(
        list_transform(string_split(t, ''), lambda c: cast(coalesce(list_sum(list_transform(
            range(length(s)), lambda k: case when substr(s, k + 1, 1) = c then 1::bigint << k else 0 end)), 0) as bigint)),
        lambda row, m: ((row + (row & m)) | (row - (row & m))) & ((1::bigint << length(s)) - 1),
        (1::bigint << length(s)) - 1))) / (length(s) + length(t)) end as r from jobs),
whole_r as (select a, b, r from whole join scored
            on s = (case when length(a) <= length(b) then a else b end)
           and t = (case when length(a) <= length(b) then b else a end)),
partial_r as (select a, b, max(r) as r from windows join scored
              on s = (case when length(short) <= length(w) then short else w end)
             and t = (case when length(short) <= length(w) then w else short end)
              group by a, b),
measured as (
  select x.p, x.i, x.q, x.field, x.common, x.only_p, x.only_q, x.spread, w1.r as plain, w2.r as sorted_r,
         greatest(w3.r, coalesce(w4.r, 0), coalesce(w5.r, 0)) as sets_r, p1.r as part,
         greatest(coalesce(p2.r, 0), coalesce(p3.r, 0)) as part_words
  from pairs x join whole_r w1 on w1.a = x.p and w1.b = x.q join whole_r w2 on w2.a = x.ps and w2.b = x.qs
  join whole_r w3 on w3.a = x.with_p and w3.b = x.with_q
  left join whole_r w4 on x.common <> '' and w4.a = x.common and w4.b = x.with_p
  left join whole_r w5 on x.common <> '' and w5.a = x.common and w5.b = x.with_q
  join partial_r p1 on p1.a = x.p and p1.b = x.q
  left join partial_r p2 on x.common = '' and p2.a = x.ps and p2.b = x.qs
  left join partial_r p3 on x.common = '' and p3.a = x.pd and p3.b = x.qd),
measures as (select *, case when common <> '' and (only_p = '' or only_q = '') then 100.0 else sets_r end as token_set,
                    case when spread <= 8 then 0.9 else 0.6 end as scale from measured),
totals as (select p, i, q, field, round(least(token_set, case when spread < 1.5
             then greatest(plain, 0.95 * greatest(sorted_r, token_set))
             else greatest(plain, scale * part, 0.95 * scale * case when common <> '' then 100.0 else part_words end) end)
           / 100.0, 4) as score from measures),
best as (select *, row_number() over (partition by p, field order by score desc, i) as n from totals),
ranked as (select *, row_number() over (partition by p order by score desc, i) as candidate_rank from best where n = 1)"""


_PROBE = "replace(" + _NORM.format("{0}") + ", '_', ' ')"
ORACLES["fuzzy_candidates"] = _fuzzy(
    f"select page_id, url as source_column, {_PROBE.format('url')} as p from pages") + """
select page_id, source_column, cast(candidate_rank as int) as candidate_rank, field as canonical_field,
       q as matched_phrase, score
from probes join ranked using (p) where candidate_rank <= 3"""
_HEADERS = "(" + _values([(s, i, h) for s, i, h, _ in D.dialect_rows()]) + ") h(dialect, ordinal, source_column)"
ORACLES["fuzzy_feed_candidates"] = _fuzzy(
    f"""select s_name as source_system, ordinal, source_column, {_PROBE.format('source_column')} as p
from supplier join {_HEADERS} on dialect = ({_ORDER})[1 + s_suppkey % 4]""") + """
select source_system, ordinal, source_column, cast(candidate_rank as int) as candidate_rank,
       field as canonical_field, q as matched_phrase, score
from probes join ranked using (p) where candidate_rank <= 4"""

# The estimate is held against the values around the median, not against the median itself.
add("daily_sla_approx", FACT, """select created_date, ifnull(borough, 'UNSPECIFIED') as borough, agency_code,
  count(*) as requests_opened, true as median_in_bounds
from fact group by all""")

ORACLES["map_varied_claims"] = _fuzzy(f"""select *, {_PROBE.format('source_column')} as p, {_NORM.format('source_column')} as norm
from (with {PARTS} select distinct source_system, source_column from parts)""") + f""",
names as (select {_NORM.format("phrase")} as norm,
                 arg_min(field, (case when phrase = replace(field, '_', ' ') then 0 else 1 end) * 1000 + i) as field
          from phrases group by 1)
select source_system, source_column,
       case when n.field is not null then n.field when score >= 0.82 then r.field end as canonical_field,
       case when n.field is not null then 'exact' when score >= 0.82 then 'fuzzy' else 'unmapped' end as method,
       case when n.field is not null then 1.0 else score end as confidence
from probes left join names n using (norm) left join (from ranked where candidate_rank = 1) r using (p)"""
