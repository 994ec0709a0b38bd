"""Plain SQL for every query, written apart from the DataFrame code it checks.

The texts are for a single-node SQL engine over the same tables. Steps that many queries
share are common table expressions; each query lists those it needs.
"""

from __future__ import annotations

from millrace.contract import EVENT_ROOTS, EVENTS, GEO_TYPE_NAMES, GEO_TYPE_OTHER
from millrace.feed import feed_oracle_sql
from millrace.queries import (
    CUT_OFF_HOUR,
    FEED_STATE,
    FILES_SQL,
    FIRST_SNAPSHOT,
    INDEX_SQL,
    MESSAGES_SQL,
    ORDERS_BATCH_SQL,
    SECOND_SNAPSHOT,
    SPLIT_FILE,
    TWICE_HOUR,
    WINDOW_END,
    WINDOW_START,
    WRONG_SUM_HOUR,
)

_ATTRIBUTES = (
    "actor_name",
    "country_code",
    "known_group_code",
    "ethnic_code",
    "religion_code",
    "type_code",
)


def _typed(index: int, kind: str) -> str:
    text = f"nullif(trim(p[{index}]), '')"
    if kind in ("int", "bigint"):
        return f"try_cast(regexp_extract({text}, '^([+-]?[0-9]*)([.][0-9]*)?$', 1) as {kind})"
    if kind == "double":
        return f"try_cast({text} as double)"
    if kind == "date":
        return (
            f"case when regexp_matches({text}, '^[0-9]{{8}}$') "
            f"then cast(try_strptime({text}, '%Y%m%d') as date) end"
        )
    if kind == "timestamp":
        return (
            f"case when regexp_matches({text}, '^[0-9]{{14}}$') "
            f"then try_strptime({text}, '%Y%m%d%H%M%S') end"
        )
    return text


_TYPED_LIST = ", ".join(
    f"{_typed(i, kind)} as {name}" for i, (name, kind) in enumerate(EVENTS.columns, 1)
)
_NAMES = ", ".join(EVENTS.names)


def _newest(where: str) -> str:
    return f"""
      select {_NAMES}, _source_file from (
        select *, row_number() over (partition by global_event_id
          order by date_added desc nulls last, _source_file desc nulls last, _raw_line desc) as rn
        from typed where global_event_id is not null and {where}) ranked where rn = 1"""


def _staged(source: str) -> str:
    actor = ", ".join(
        f"actor{r}_{c}{n}"
        for r in (1, 2)
        for c, n in (
            ("code", ""),
            ("name", ""),
            ("country_code", ""),
            ("known_group_code", ""),
            ("ethnic_code", ""),
            ("religion1_code", f" as actor{r}_religion_code"),
            ("type1_code", f" as actor{r}_type_code"),
        )
    )
    return f"""
      select global_event_id, sql_date, fraction_date, {actor}, is_root_event, event_code,
        event_base_code, event_root_code, quad_class, goldstein_scale, num_mentions,
        num_sources, num_articles, avg_tone, action_geo_type, action_geo_fullname,
        action_geo_country_code, action_geo_adm1_code, action_geo_lat, action_geo_long,
        action_geo_feature_id, date_added, source_url from {source}"""


def _mentions(source: str) -> str:
    roles = [
        "select "
        + ", ".join(
            f"actor{r}_{c} as {a}"
            for c, a in (
                ("code", "actor_code"),
                ("name", "actor_name"),
                ("country_code", "country_code"),
                ("known_group_code", "known_group_code"),
                ("ethnic_code", "ethnic_code"),
                ("religion_code", "religion_code"),
                ("type_code", "type_code"),
            )
        )
        + f" from {source} where actor{r}_code is not null"
        for r in (1, 2)
    ]
    return " union all ".join(roles)


def _attributes(source: str) -> str:
    greatest = ", ".join(f"max({a}) as {a}" for a in _ATTRIBUTES)
    return (
        f"select actor_code, {greatest} from ({_mentions(source)}) mentions group by actor_code"
    )


def _fact(source: str, limit: str = "timestamp '1900-01-01'") -> str:
    return f"""
      select global_event_id as event_key,
        cast(strftime(sql_date, '%Y%m%d') as integer) as date_key,
        md5(actor1_code) as actor1_key, md5(actor2_code) as actor2_key,
        md5(coalesce(action_geo_feature_id, action_geo_fullname)) as action_geo_key,
        md5(event_code) as cameo_key, is_root_event, quad_class, source_url, goldstein_scale,
        num_mentions, num_sources, num_articles, avg_tone, date_added
      from {source} where date_added > {limit}"""


_PLACE_LABELS = ", ".join(f"({code}, '{label}')" for code, label in GEO_TYPE_NAMES.items())
# column of a place: the field of the event it is taken from
_PLACE_FIELDS = {
    "geo_type": "type", "geo_fullname": "fullname", "country_code": "country_code", "adm1_code": "adm1_code",
    "latitude": "lat", "longitude": "long", "feature_id": "feature_id",
}
_PLACE_MAXIMA = ", ".join(f"max(action_geo_{f}) as {name}" for name, f in _PLACE_FIELDS.items())
_ROOT_ROWS = ", ".join(f"('{c}', '{d}', {q}, '{n}')" for c, d, q, n in EVENT_ROOTS)
_T1, _T2 = f"timestamp '{FIRST_SNAPSHOT}'", f"timestamp '{SECOND_SNAPSHOT}'"
_SAME = " and ".join(f"o.{a} is not distinct from n.{a}" for a in _ATTRIBUTES)
_VERSION = ", ".join(("actor_code", *_ATTRIBUTES))


def _opened(alias: str, source: str, since: str, where: str = "true") -> str:
    columns = ", ".join(f"{alias}.{c}" for c in ("actor_code", *_ATTRIBUTES))
    return f"""
      select {columns}, md5({alias}.actor_code || '|' || strftime({since}, '%Y-%m-%d %H:%M:%S.%f'))
          as scd_id,
        {since} as updated_at, {since} as valid_from, cast(null as timestamp) as valid_to
      from {source} where {where}"""


_STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "feed": ((), feed_oracle_sql()),
    "fields": (
        ("feed",),
        "select *, case when len(p) = 62 and p[62] = '' then 61 else len(p) end as n "
        "from (select *, string_split(_raw_line, chr(9)) as p from feed) split_lines",
    ),
    "typed": (
        ("fields",),
        f"select {_TYPED_LIST}, _source_file, _raw_line from fields where n = 61",
    ),
    "silver": (("typed",), _newest("true")),
    "silver_of_day": (("typed",), _newest("substr(_source_file, 1, 8) = '20240115'")),
    "silver_first": (("typed",), _newest(f"_source_file < '{SPLIT_FILE}'")),
    "silver_second": (("typed",), _newest(f"_source_file >= '{SPLIT_FILE}'")),
    "staged": (("silver",), _staged("silver")),
    "staged_first": (("silver_first",), _staged("silver_first")),
    "staged_second": (("silver_second",), _staged("silver_second")),
    "fact": (("staged",), _fact("staged")),
    "fact_first": (("staged_first",), _fact("staged_first")),
    "attributes": (("staged",), _attributes("staged")),
    "attributes_first": (("staged_first",), _attributes("staged_first")),
    "attributes_second": (("staged_second",), _attributes("staged_second")),
    "opened_first": (("attributes_first",), _opened("a", "attributes_first a", _T1)),
    "history": (
        ("opened_first", "attributes_second"),
        f"""
      select {_VERSION}, scd_id, case when ended then {_T2} else updated_at end as updated_at,
        valid_from, case when ended then {_T2} end as valid_to
      from (select o.*, n.actor_code is not null and not ({_SAME}) as ended
        from opened_first o left join attributes_second n on o.actor_code = n.actor_code) compared
      union all
      {
            _opened(
                "n",
                "attributes_second n left join opened_first o on o.actor_code = n.actor_code",
                _T2,
                f"o.actor_code is null or not ({_SAME})",
            )
        }""",
    ),
    "dates": (
        ("staged",),
        """
      select cast(strftime(sql_date, '%Y%m%d') as integer) as date_key, sql_date as full_date,
        cast(extract(year from sql_date) as integer) as year,
        cast(extract(quarter from sql_date) as integer) as quarter,
        cast(extract(month from sql_date) as integer) as month,
        monthname(sql_date) as month_name,
        cast(extract(day from sql_date) as integer) as day_of_month,
        cast(extract(dow from sql_date) as integer) as day_of_week,
        dayname(sql_date) as day_name, extract(dow from sql_date) in (0, 6) as is_weekend
      from (select distinct sql_date from staged where sql_date is not null) days""",
    ),
    "places": (
        ("staged",),
        f"""
      with named as (
        select coalesce(action_geo_feature_id, action_geo_fullname) as place_name, * from staged
      ), merged as (
        select place_name, {_PLACE_MAXIMA} from named where place_name is not null group by place_name
      )
      select md5(place_name) as geo_key, place_name as geo_natural_key, merged.geo_type,
        coalesce(labels.label, '{GEO_TYPE_OTHER}') as geo_type_name,
        merged.* exclude (place_name, geo_type)
      from merged left join (values {_PLACE_LABELS}) labels(code, label) on labels.code = merged.geo_type""",
    ),
    "event_types": (
        ("staged",),
        f"""
      select md5(e.event_code) as cameo_key, e.event_code, e.event_base_code,
        e.event_root_code, r.root_description, e.quad_class, r.quad_class_name
      from (select distinct event_code, event_base_code, event_root_code, quad_class
        from staged where event_code is not null) e
      left join (values {_ROOT_ROWS}) r(code, root_description, quad_class, quad_class_name)
        on lpad(e.event_root_code, 2, '0') = r.code""",
    ),
    "index_lines": ((), INDEX_SQL.format(events="events")),
    "manifest": (
        ("index_lines",),
        r"""
      select url, size, md5, file_ts, feed, file_name, cast(file_ts as date) as dt,
        cast(extract(hour from file_ts) as integer) as hour
      from (select p[3] as url, try_cast(p[1] as bigint) as size, p[2] as md5,
          try_strptime(regexp_extract(p[3], '([0-9]{14})\.(export|mentions|gkg)\.', 1, 'i'),
            '%Y%m%d%H%M%S') as file_ts,
          lower(regexp_extract(p[3], '([0-9]{14})\.(export|mentions|gkg)\.', 2, 'i')) as feed,
          regexp_extract(p[3], '[^/]*$') as file_name
        from (select regexp_split_to_array(regexp_replace(value, '^\s+|\s+$', '', 'g'), '\s+')
          as p from index_lines) cut where len(p) = 3) entries
      where size is not null and file_ts is not null and feed <> ''""",
    ),
    "files": ((), FILES_SQL.format(documents="documents")),
    "outcome": (
        ("files",),
        """
      select feed, file_name, md5, case when known then 'skipped'
        when md5 = '' or md5 = md5(text) then 'landed' else 'failed' end as status from files""",
    ),
    # what comes out of the archives: a bad byte is replaced, a carriage return at the end is cut
    "archived": (
        ("feed",),
        "select _source_file, case when length(_raw_line) % 7 = 0 then concat(_raw_line, chr(65533)) "
        "else _raw_line end as _raw_line from feed",
    ),
    "orders_batch": ((), ORDERS_BATCH_SQL.format(orders="orders")),
    "messages": ((), MESSAGES_SQL.format(events="events")),
}


def _query(body: str, *steps: str) -> str:
    """The body below the steps it needs, each step after those it builds on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _STEPS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for step in steps:
        add(step)
    head = ", ".join(f"{name} as ({_STEPS[name][1]})" for name in ordered)
    return f"with {head} {body}"


def _checks(source: str) -> str:
    def ranged(column: str, low: object, high: object) -> str:
        return f"count(*) filter (where {column} < {low} or {column} > {high})"

    rows = [
        ("global_event_id: not null", "error", "count(*) filter (where global_event_id is null)"),
        (
            "global_event_id: unique",
            "error",
            "count(global_event_id) - count(distinct global_event_id)",
        ),
        ("sql_date: not null", "error", "count(*) filter (where sql_date is null)"),
        ("quad_class: in set", "error", "count(*) filter (where quad_class not in (1, 2, 3, 4))"),
        ("goldstein_scale: between -10 and 10", "warn", ranged("goldstein_scale", -10, 10)),
        ("avg_tone: between -100 and 100", "warn", ranged("avg_tone", -100, 100)),
        ("num_articles: between 0 and 1e+06", "warn", ranged("num_articles", 0, 1000000)),
        ("action_geo_lat: between -90 and 90", "warn", ranged("action_geo_lat", -90, 90)),
        ("action_geo_long: between -180 and 180", "warn", ranged("action_geo_long", -180, 180)),
    ]
    parts = [
        f"select '{name}' as check_name, '{severity}' as severity, {count} as failures, "
        f"{count} = 0 as passed from {source}"
        for name, severity, count in rows
    ]
    return " union all ".join(parts)


def _stripped(position: int) -> str:
    return f"nullif(regexp_replace(p[{position}], '^\\s+|\\s+$', '', 'g'), '')"


def _stream_fields() -> str:
    def text(name: str) -> str:
        return _stripped(EVENTS.position(name) + 1)

    def whole(name: str) -> str:
        t = text(name)
        return f"case when regexp_matches({t}, '^[+-]?[0-9]+$') then try_cast({t} as bigint) end"

    def real(name: str) -> str:
        return f"try_cast({text(name)} as double)"

    day = text("sql_date")
    columns = {
        "global_event_id": whole("global_event_id"),
        "event_day": f"case when length({day}) = 8 then "
        f"{day}[1:4] || '-' || {day}[5:6] || '-' || {day}[7:8] end",
        "actor1_name": text("actor1_name"),
        "actor2_name": text("actor2_name"),
        "actor1_country_code": text("actor1_country_code"),
        "actor2_country_code": text("actor2_country_code"),
        "event_code": text("event_code"),
        "event_root_code": text("event_root_code"),
        "quad_class": whole("quad_class"),
        "goldstein_scale": real("goldstein_scale"),
        "num_mentions": whole("num_mentions"),
        "avg_tone": real("avg_tone"),
        "action_country_code": text("action_geo_country_code"),
        "action_location": text("action_geo_fullname"),
        "action_lat": real("action_geo_lat"),
        "action_long": real("action_geo_long"),
        "date_added": text("date_added"),
        "source_url": text("source_url"),
    }
    return ", ".join(f"{value} as {name}" for name, value in columns.items())


_STEPS["stream_rows"] = (("fields",), f"select {_stream_fields()} from fields")


def _number(name: str) -> str:
    return f"try_cast(json_extract_string(j, '$.{name}') as double)"


_NUMERIC = (
    "quad_class",
    "goldstein_scale",
    "num_mentions",
    "avg_tone",
    "action_lat",
    "action_long",
)
_WRONG_TYPE = " or ".join(f"json_type(j, '$.{name}') in ('VARCHAR', 'BOOLEAN')" for name in _NUMERIC)


def _out_of(name: str, low: int, high: int, code: str) -> str:
    return f"case when not {_number(name)} between {low} and {high} then '{code}' end"


_STEPS["decoded"] = (
    ("messages",),
    f"""
      select message_key, body, j, case when j is null or json_type(j) <> 'OBJECT' then true
        else coalesce({_WRONG_TYPE}, false) end as broken
      from (select *, case when body is not null and json_valid(body) then cast(body as json) end
        as j from messages) parsed""",
)
_STEPS["judged"] = (
    ("decoded",),
    f"""
      select *, case when broken then 'undecodable' when codes <> '' then 'invalid'
        when coalesce({_number("goldstein_scale")} <= -8, false)
          or coalesce({_number("quad_class")} = 4, false)
          and coalesce({_number("num_mentions")}, 0) >= 10 then 'alert' else 'valid' end as outcome
      from (select *, case when not broken then concat_ws(',',
          case when json_extract_string(j, '$.global_event_id') is null
            then 'global_event_id_missing' end,
          case when coalesce(json_extract_string(j, '$.event_day'), '') = ''
            then 'event_day_missing' end,
          case when {_number("quad_class")} not in (1, 2, 3, 4)
            then 'quad_class_out_of_range' end,
          {_out_of("goldstein_scale", -10, 10, "goldstein_out_of_range")},
          {_out_of("avg_tone", -100, 100, "avg_tone_out_of_range")},
          {_out_of("action_lat", -90, 90, "action_lat_out_of_range")},
          {_out_of("action_long", -180, 180, "action_long_out_of_range")}) end as codes
        from decoded) coded""",
)

_STATE_ROWS = ", ".join(f"('{feed}', timestamp '{ts}')" for feed, ts in FEED_STATE)
_RAW_LIST = ", ".join(f"p[{i}] as {name}" for i, name in enumerate(EVENTS.names, 1))
_KEY = (
    "coalesce(nullif(action_country_code, ''), nullif(actor1_country_code, ''))"
)

ORACLE: dict[str, str] = {
    "index_parse": _query("select * from manifest", "manifest"),
    "index_window": _query(
        f"""select * from manifest where feed in ('export', 'gkg')
        and file_ts >= timestamp '{WINDOW_START}' and file_ts < timestamp '{WINDOW_END}'""",
        "manifest",
    ),
    "index_not_landed": _query(
        f"""select * from manifest m where not exists (select 1 from manifest l
        where l.file_ts < timestamp '{WINDOW_START}' and l.feed = m.feed
        and l.file_name = m.file_name)""",
        "manifest",
    ),
    "checksum_status": _query("select * from outcome", "outcome"),
    "landing_tally": _query(
        """select count(*) filter (where status = 'landed') as landed,
        count(*) filter (where status = 'skipped') as skipped,
        count(*) filter (where status = 'failed') as failed from outcome""",
        "outcome",
    ),
    "feed_checkpoint": _query(
        f"""select coalesce(s.feed, m.feed) as feed, greatest(s.ts, m.ts) as ts
        from (values {_STATE_ROWS}) s(feed, ts)
        full join (select feed, max(file_ts) as ts from manifest group by feed) m
        on s.feed = m.feed""",
        "manifest",
    ),
    "newest_batch": _query(
        "select * from feed where _source_file = (select max(_source_file) from feed)", "feed"
    ),
    "contract_fields": _query(
        f"select {_RAW_LIST}, _source_file, cast(n as integer) as _field_count, _raw_line "
        "from fields",
        "fields",
    ),
    "contract_rejects": _query(
        "select _raw_line, cast(n as integer) as _field_count, 61 as _expected_count, "
        "_source_file from fields where n <> 61",
        "fields",
    ),
    "reject_distribution": _query(
        "select cast(n as integer) as _field_count, count(*) as line_count from fields "
        "where n <> 61 group by n",
        "fields",
    ),
    "malformed_rate": _query(
        """select count(*) as total, count(*) filter (where n <> 61) as malformed,
        count(*) filter (where n <> 61) / cast(count(*) as double) as rate from fields""",
        "fields",
    ),
    "typed_clean": _query(f"select {_NAMES}, _source_file from typed", "typed"),
    "latest_per_key": _query("select * from silver", "silver"),
    "quality_suite": _query(_checks("silver"), "silver"),
    "quality_suite_before_dedup": _query(_checks("typed"), "typed"),
    "day_reprocess": _query("select * from silver_of_day", "silver_of_day"),
    "silver_loaded": _query("select * from silver", "silver"),
    "upsert_newest": _query(
        """select coalesce(t.o_orderkey, s.o_orderkey) as o_orderkey,
          case when take then s.o_custkey else t.o_custkey end as o_custkey,
          case when take then s.o_orderstatus else t.o_orderstatus end as o_orderstatus,
          case when take then s.o_totalprice else t.o_totalprice end as o_totalprice,
          case when take then s.o_orderdate else t.o_orderdate end as o_orderdate,
          case when take then s.o_orderpriority else t.o_orderpriority end as o_orderpriority
        from (select t, s, t.o_orderkey is null or coalesce(s.o_orderdate >= t.o_orderdate, false) as take
          from orders t full join orders_batch s on t.o_orderkey = s.o_orderkey) pairs""",
        "orders_batch",
    ),
    "upsert_orders": _query(
        """select * from orders t where not exists
          (select 1 from orders_batch s where s.o_orderkey = t.o_orderkey)
        union all select * from orders_batch""",
        "orders_batch",
    ),
    "stage_events": _query("select * from staged", "staged"),
    "fact_full": _query("select * from fact", "fact"),
    "fact_incremental": _query(
        """, added as ("""
        + _fact("staged", "(select max(date_added) from fact_first)")
        + """) select * from fact_first where event_key not in (select event_key from added)
        union all select * from added""",
        "fact_first",
        "staged",
    ),
    "actor_union": _query(_mentions("staged"), "staged"),
    "actor_attributes": _query("select * from attributes", "attributes"),
    "actor_history": _query("select * from history", "history"),
    "actor_current": _query(
        f"""select md5(actor_code) as actor_key, {_VERSION}, valid_from, valid_to,
        true as is_current from history where valid_to is null""",
        "history",
    ),
    "actor_as_of": _query(
        f"""select f.global_event_id, f.actor1_code, f.date_added,
        {", ".join("h." + a for a in _ATTRIBUTES)}, h.valid_from, h.valid_to
        from staged f left join history h on f.actor1_code = h.actor_code
          and f.date_added >= h.valid_from
          and (h.valid_to is null or f.date_added < h.valid_to)""",
        "staged",
        "history",
    ),
    "dim_date": _query("select * from dates", "dates"),
    "dim_geography": _query("select * from places", "places"),
    "dim_cameo_event": _query("select * from event_types", "event_types"),
    "star_rollup_by_root": _query(
        """select d.year, d.month, t.root_description, t.quad_class_name,
          a.country_code as actor_country, g.country_code as place_country,
          count(*) as event_count,
          round(cast(sum(cast(f.avg_tone as decimal(18,4))) as double) / count(f.avg_tone), 6)
            as mean_tone
        from fact f left join dates d on f.date_key = d.date_key
        left join event_types t on f.cameo_key = t.cameo_key
        left join places g on f.action_geo_key = g.geo_key
        left join attributes a on f.actor1_key = md5(a.actor_code) group by all""",
        "fact",
        "dates",
        "event_types",
        "places",
        "attributes",
    ),
    "star_month": _query(
        """select d.year, d.month, t.root_description, t.quad_class_name,
          a.country_code as actor_country, g.country_code as place_country,
          count(*) as event_count,
          round(cast(sum(cast(f.avg_tone as decimal(18,4))) as double) / count(f.avg_tone), 6)
            as mean_tone
        from fact f join dates d on f.date_key = d.date_key
          and d.year = 2024 and d.month = 1 and d.is_weekend
        left join event_types t on f.cameo_key = t.cameo_key
        left join places g on f.action_geo_key = g.geo_key
        left join attributes a on f.actor1_key = md5(a.actor_code) group by all""",
        "fact",
        "dates",
        "event_types",
        "places",
        "attributes",
    ),
    "test_unique": _query(
        """select global_event_id as value, count(*) as row_count from typed
        where global_event_id is not null group by 1 having count(*) > 1""",
        "typed",
    ),
    "test_not_null": _query(
        """select count(*) as row_count from typed where global_event_id is null
        having count(*) > 0""",
        "typed",
    ),
    "test_accepted": _query(
        """select quad_class as value, count(*) as row_count from fact
        where quad_class not in (1, 2, 3) group by 1""",
        "fact",
    ),
    "test_relationships": _query(
        """select date_key as value, count(*) as row_count from fact f
        where date_key is not null and not exists (select 1 from staged_first s
          where cast(strftime(s.sql_date, '%Y%m%d') as integer) = f.date_key) group by 1""",
        "fact",
        "staged_first",
    ),
    "stream_projection": _query("select * from stream_rows", "stream_rows"),
    "stream_messages": _query(
        f"select {_KEY} as message_key, cast(to_json(stream_rows) as varchar) as body from stream_rows",
        "stream_rows",
    ),
    "stream_gate": _query("select message_key, outcome, codes from judged", "judged"),
    "stream_routes": _query(
        """select case when outcome = 'alert' then 'alerts' else 'dlq' end as topic, message_key,
          case when outcome <> 'invalid' then body else
            regexp_replace(body, '[}]$', '') || case when body = '{}' then '' else ',' end
            || '"_violations":["' || replace(codes, ',', '","') || '"]}' end as body
        from judged where outcome <> 'valid'""",
        "judged",
    ),
    "stream_stats": _query(
        """select count(*) as consumed,
        count(*) filter (where outcome in ('valid', 'alert')) as valid,
        count(*) filter (where outcome in ('undecodable', 'invalid')) as dead_lettered,
        count(*) filter (where outcome = 'alert') as alerts from judged""",
        "judged",
    ),
    "stream_bounded": _query(
        """select count(*) as consumed,
        count(*) filter (where outcome in ('valid', 'alert')) as valid,
        count(*) filter (where outcome in ('undecodable', 'invalid')) as dead_lettered,
        count(*) filter (where outcome = 'alert') as alerts, true as limited from judged""",
        "judged",
    ),
    "compact_partitions": _query(
        f"""select substr(_source_file, 1, 8) as day,
        count(*) + count(*) filter (where _source_file < '{SPLIT_FILE}') as row_count,
        true as settled from feed group by 1""",
        "feed",
    ),
    "flagship": _query(
        """select quad_class, count(*) as event_count,
        round(cast(sum(cast(avg_tone as decimal(18,4))) as double) / count(avg_tone), 3)
          as mean_tone from fact group by 1""",
        "fact",
    ),
}

_BAD_HOURS = f"('{CUT_OFF_HOUR}', '{WRONG_SUM_HOUR}', '{TWICE_HOUR}')"

ORACLE["archive_scan"] = _query(
    f"select _raw_line, _source_file from archived where _source_file >= '{SPLIT_FILE}'", "archived"
)
ORACLE["archive_stream"] = _query("select _source_file, count(*) as line_count from archived group by 1", "archived")
ORACLE["landing_run"] = _query(
    f"""select _raw_line, _source_file, 'export' as feed,
      cast(strptime(substr(_source_file, 1, 8), '%Y%m%d') as date) as dt,
      cast(substr(_source_file, 9, 2) as integer) as hour,
      concat(good, '/0/', bad) as first_run, concat('0/', good, '/', bad) as second_run
    from archived cross join (
      select count(distinct _source_file) filter (where substr(_source_file, 9, 2) not in {_BAD_HOURS}) as good,
        count(distinct _source_file) filter (where substr(_source_file, 9, 2) in {_BAD_HOURS}) as bad from feed) files
    where substr(_source_file, 9, 2) not in {_BAD_HOURS}""",
    "archived",
)
ORACLE["fact_table_loaded"] = ORACLE["fact_incremental"]
ORACLE["rejects_loaded"] = ORACLE["contract_rejects"]
ORACLE["actor_history_table"] = ORACLE["actor_history"]
ORACLE["topic_sink"] = ORACLE["stream_routes"]
ORACLE["stream_set_aside"] = _query(
    """select count(*) as consumed,
    count(*) filter (where outcome in ('valid', 'alert')) as valid,
    count(*) filter (where outcome in ('undecodable', 'invalid')) as dead_lettered,
    count(*) filter (where outcome = 'alert') as alerts, cast(1 as bigint) as damaged_files from judged""",
    "judged",
)
ORACLE["topic_order"] = _query(
    f"""select message_key, body,
      row_number() over (partition by message_key order by _source_file, body) - 1 as position
    from (select _source_file, {_KEY} as message_key, cast(to_json(stream_rows) as varchar) as body
      from fields, lateral (select {_stream_fields()}) stream_rows) sent""",
    "fields",
)
ORACLE["archives_to_silver"] = ORACLE["silver_loaded"]


def _gold_built() -> str:
    """Counts of the gold tables and of what fails their tests, one row each."""
    keys = {
        "events": ("silver", "global_event_id"),
        "dim_date": ("dates", "date_key"),
        "dim_actor": ("actors", "actor_key"),
        "dim_geography": ("places", "geo_key"),
        "dim_cameo_event": ("event_types", "cameo_key"),
        "fact_events": ("fact", "event_key"),
    }
    parts = []
    for table, (rows, key) in keys.items():
        twice = f"select {key} from {rows} where {key} is not null group by 1 having count(*) > 1"
        parts.append(f"select 'unique_{table}_{key}' as name, count(*) as n from ({twice}) twice")
        parts.append(f"select 'not_null_{table}_{key}', count(*) from {rows} where {key} is null")
        if table != "events":
            parts.append(f"select '{table}', count(*) from {rows}")
    for column, parent in (
        ("date_key", "dim_date"),
        ("actor1_key", "dim_actor"),
        ("actor2_key", "dim_actor"),
        ("action_geo_key", "dim_geography"),
        ("cameo_key", "dim_cameo_event"),
    ):
        rows, key = keys[parent]
        parts.append(
            f"""select 'relationships_fact_events_{column}', count(distinct {column}) from fact
            where {column} is not null and {column} not in (select {key} from {rows})"""
        )
    parts.append("select 'not_null_dim_actor_actor_code', count(*) from actors where actor_code is null")
    parts.append(
        """select 'accepted_values_dim_cameo_event_quad_class', count(distinct quad_class)
        from event_types where quad_class not in (1, 2, 3, 4)"""
    )
    parts.append(f"select 'event_roots', count(*) from (values {_ROOT_ROWS}) roots")
    actors = "actors as (select md5(actor_code) as actor_key, * from attributes)"
    steps = ("silver", "dates", "places", "event_types", "fact", "attributes")
    return _query(f", {actors} {' union all '.join(parts)}", *steps)


ORACLE["gold_built"] = _gold_built()
