"""All registered queries with their check SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelmill.plans import checks_inputs, checks_reads, checks_state, checks_store

_ALL = {
    **checks_reads.QUERIES,
    **checks_inputs.QUERIES,
    **checks_state.QUERIES,
    **checks_store.QUERIES,
}


def _in_utc(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # instants are shown and cut to dates in UTC, whatever the machine's zone
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _in_utc(fn) for name, (fn, _) in sorted(_ALL.items())}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in sorted(_ALL.items()) if sql}
