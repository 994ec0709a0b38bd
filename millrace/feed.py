"""A synthetic feed of contract lines, derived from the test tables by one SQL text.

The text runs unchanged in Spark and in the SQL oracle, so both sides start from the same
lines; what is computed from the lines is written separately on each side.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.contract import EVENTS
from millrace.operators.lines import conformant
from millrace.operators.silver import newest_lines, type_lines
from millrace.session import scratch_root
from millrace.sources.tables import balanced, open_writers


def _digits(moment: str, length: int) -> str:
    text = f"cast({moment} as string)"
    for mark in ("-", ":", " "):
        text = f"replace({text}, '{mark}', '')"
    return f"substr({text}, 1, {length})"


# what each column holds; every column that is not named stays empty
_VALUES = {
    "global_event_id": "case when id % 79 = 13 then '' else cast(id as string) end",
    "sql_date": _digits("ts", 8),
    "month_year": _digits("ts", 6),
    "year": _digits("ts", 4),
    "fraction_date": f"concat({_digits('ts', 4)}, '.5')",
    "actor1_code": "case when id % 23 = 0 then '' else concat('A', cast(u as string)) end",
    "actor1_name": "case when id % 61 = 1 then concat('  ', c_name, ' ') else c_name end",
    "actor1_country_code": "concat('N', cast(n_nationkey as string))",
    "actor1_religion1_code": "concat('R', cast(id % 3 as string))",
    "actor1_type1_code": "c_mktsegment",
    "actor2_code": "case when id % 5 = 0 then '' "
    "else concat('A', cast((u + id) % 200 as string)) end",
    "actor2_name": "concat('name ', cast((u + id) % 200 as string))",
    "actor2_country_code": "case when id % 7 = 0 then '' "
    "else concat('N', cast(id % 25 as string)) end",
    "is_root_event": "cast(id % 2 as string)",
    "event_code": "case event_type when 'click' then '010' when 'view' then '0211' "
    "when 'signup' then '057' when 'purchase' then '141' when 'error' then '190' end",
    "event_base_code": "case event_type when 'click' then '010' when 'view' then '021' "
    "when 'signup' then '057' when 'purchase' then '141' when 'error' then '190' end",
    "event_root_code": "case event_type when 'click' then '1' when 'view' then '02' "
    "when 'signup' then '05' when 'purchase' then '14' when 'error' then '19' end",
    "quad_class": "case event_type when 'click' then '1' when 'view' then '1' "
    "when 'signup' then '2' when 'purchase' then '3' when 'error' then '4' end",
    "goldstein_scale": "case when id % 131 = 9 then '99' else concat("
    "case when id % 201 < 100 then '-' else '' end, "
    "cast((abs(id % 201 - 100) - abs(id % 201 - 100) % 10) / 10 as int), '.', "
    "cast(abs(id % 201 - 100) % 10 as string)) end",
    "num_mentions": "case when id % 71 = 3 then '1.5' else cast(id % 25 as string) end",
    "num_sources": "case when id % 67 = 2 then 'abc' else cast(id % 9 as string) end",
    "num_articles": "cast(id % 40 as string)",
    "avg_tone": "case when again then concat('-', cast(id % 100 as string), '.25') "
    "else concat(cast(id % 100 as string), '.5') end",
    "action_geo_type": "cast(u % 6 as string)",
    "action_geo_fullname": "case when u % 11 = 0 then '' else n_name end",
    "action_geo_country_code": "case when id % 13 = 0 then '' "
    "else concat('N', cast(n_nationkey as string)) end",
    "action_geo_adm1_code": "concat('M', cast(u % 4 as string))",
    "action_geo_lat": "concat(case when id % 2 = 1 then '-' else '' end, "
    "cast(u % 90 as string), '.5')",
    "action_geo_long": "concat(case when id % 2 = 1 then '-' else '' end, "
    "cast(id % 180 as string), '.25')",
    "action_geo_feature_id": "case when u % 3 = 0 then '' "
    "else concat('F', cast(n_nationkey as string)) end",
    "date_added": _digits("added", 14),
    "source_url": "concat('http://h/', cast(id as string))",
}


def _feed_sql() -> str:
    fields = [f"coalesce({_VALUES.get(name, chr(39) * 2)}, '')" for name in EVENTS.names]
    head = ", ".join(fields[:-1])
    return f"""
select concat(
    concat_ws(chr(9), {head}),
    case when id % 97 = 5 then ''
         when id % 89 = 7 then concat(chr(9), {fields[-1]}, chr(9), 'x')
         when id % 83 = 11 then concat(chr(9), {fields[-1]}, chr(9))
         else concat(chr(9), {fields[-1]}) end) as _raw_line,
  concat({_digits("added", 10)}, '0000.export.CSV.zip') as _source_file
from (
  select e.event_id as id, e.user_id as u, e.ts, e.event_type, c.c_name, c.c_mktsegment,
    n.n_nationkey, n.n_name, false as again, e.ts as added
  from {{events}} e left join {{customer}} c on e.user_id = c.c_custkey
    left join {{nation}} n on c.c_nationkey = n.n_nationkey
  union all
  select e.event_id, e.user_id, e.ts, e.event_type, c.c_name, c.c_mktsegment,
    n.n_nationkey, n.n_name, true, e.ts + interval '1' hour
  from {{events}} e left join {{customer}} c on e.user_id = c.c_custkey
    left join {{nation}} n on c.c_nationkey = n.n_nationkey
  where e.event_id % 10 = 0
) copies
"""


FEED_SQL = _feed_sql()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as lines: ``_raw_line``, ``_source_file``."""
    names = ("events", "customer", "nation")
    return spark.sql(FEED_SQL, **{name: table(spark, sf_dir, name) for name in names})


def landed(
    spark: SparkSession,
    sf_dir: str,
    step: str,
    build: Callable[[], DataFrame],
    partition: str | None = None,
) -> DataFrame:
    """A step of the pipeline as a table, written on first use in a session.

    Bronze lines, silver events and the actor history are tables that later steps read, as
    they are in a running pipeline; they are not worked out again by each query. They live
    below the shared scratch folder of the cluster. A step with a ``partition`` is built
    balanced by it.
    """
    place = (spark.sparkContext.applicationId, sf_dir, step)
    if place in _LANDED:
        try:
            return spark.read.parquet(_LANDED[place])
        except AnalysisException:  # the scratch folder was cleared: land again
            del _LANDED[place]
    path = f"{scratch_root(spark)}/millrace-{step}-{uuid.uuid4().hex}"
    if partition is None:
        build().write.parquet(path)
    else:
        with open_writers(spark):
            build().write.partitionBy(partition).parquet(path)
    _LANDED[place] = path
    return spark.read.parquet(_LANDED[place])


_LANDED: dict[tuple[str, str, str], str] = {}


def bronze_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a landed table with one folder per day, ``dt`` taken from the file name."""

    def build() -> DataFrame:
        day = F.to_date(F.substring("_source_file", 1, 8), "yyyyMMdd")
        return balanced(feed_lines(spark, sf_dir).withColumn("dt", day), "dt")

    return landed(spark, sf_dir, "lines", build, "dt").select("_raw_line", "_source_file", "dt")


def bronze_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed lines without their day."""
    return bronze_days(spark, sf_dir).drop("dt")


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a landed silver table with one folder per event day.

    Lines are brought to their day before they are typed: they are narrower than typed rows.
    """

    def build() -> DataFrame:
        newest = newest_lines(conformant(bronze_lines(spark, sf_dir)), carried=(EVENTS.day,))
        return type_lines(balanced(newest, EVENTS.day))

    events = landed(spark, sf_dir, "silver", build, EVENTS.day)
    return events.select(*EVENTS.names, "_source_file")


def feed_oracle_sql() -> str:
    """The same text over the views of the oracle."""
    return FEED_SQL.format(events="events", customer="customer", nation="nation")
