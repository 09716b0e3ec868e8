"""Join of a fact table to a dimension with one row per key, safe for hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import is_remote

# A dimension is broadcast only if Catalyst's size estimate is below this.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024
# Beyond it, the fact rows of one key are spread over tasks of about this many
# rows. At most total_rows / ROWS_PER_SALT keys can be hot, which bounds the
# broadcast list of hot keys (10^12 rows -> 10^5 keys).
ROWS_PER_SALT = 10_000_000
# Salts of keys that are known to the fact rows anyway cost nothing.
ROWS_PER_SALT_SMALL = 100_000
# Tables of more bytes than the first are dealt over tasks of at most about the second,
# which adaptive execution does not merge; the third says that nothing is known of a size.
DEAL_BYTES, TASK_BYTES, UNKNOWN_BYTES = 64 << 20, 8 << 20, 1 << 40


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, limit_bytes: int | None = None) -> bool:
    """Whether a plan is estimated small. A remote session cannot tell: no."""
    if is_remote():
        return False
    limit = BROADCAST_LIMIT_BYTES if limit_bytes is None else limit_bytes
    return estimated_bytes(df) <= limit


def tasks_for(table: DataFrame) -> int | None:
    """Tasks over which to deal what is derived from a table, if their state grows more than
    adaptive execution can see from what is shuffled; None leaves the number to it."""
    if is_remote():
        return None
    size = estimated_bytes(table)
    if size <= DEAL_BYTES:
        return None
    usual = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return usual if size >= UNKNOWN_BYTES else max(usual, -(-size // TASK_BYTES))


def join_dimension(
    fact: DataFrame,
    dimension: DataFrame,
    key: str | list[str],
    weight: str,
    spread_by: list[str],
    how: str = "inner",
    limit_bytes: int | None = None,
    rows_per_salt: int | None = None,
    partition: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Join ``fact`` to ``dimension`` (unique on ``key``) without a hot task.

    ``weight`` is the dimension column that bounds the number of fact rows of a
    key. A small dimension is broadcast. Otherwise each key gets
    ``ceil(weight / rows_per_salt)`` salts: the dimension row is repeated once
    per salt, and the fact rows of that key pick a salt by a hash of
    ``spread_by``, columns that tell the rows of a key apart. Only the hot keys
    (more than one salt) are broadcast to the fact side; every other key has
    salt 0 on both sides.

    Fact rows whose key the dimension lacks have salt 0 in an outer join; with a stored
    dimension both sides of that join are plain shuffles, which AQE splits where such a
    key is hot.

    With ``partition`` the result is partitioned by the key and its ``_salt``,
    which stays in it: a grouping by key, salt and more then needs no shuffle. The fact
    rows are dealt so (over ``tasks`` of them, if given), and stay so as the join is merged:
    adaptive execution would broadcast few fact rows if it knew their size first.
    """
    keys = [key] if isinstance(key, str) else list(key)
    dealt = [*([tasks] if tasks else []), *keys, "_salt"]
    if fits_broadcast(dimension, limit_bytes):
        if not partition:
            return fact.join(F.broadcast(dimension.drop(weight)), keys, how)
        salts = _salts(weight, rows_per_salt or ROWS_PER_SALT_SMALL)
        joined = fact.join(F.broadcast(dimension), keys, how)
        joined = joined.withColumn("_salt", _pick(spread_by, salts)).drop(weight)
        return joined.repartition(*dealt)

    salts = _salts(weight, rows_per_salt or ROWS_PER_SALT)
    hot = dimension.select(*keys, salts.alias("_salts")).filter("_salts > 1")
    salted_fact = (
        fact.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", _pick(spread_by, F.coalesce("_salts", F.lit(1))))
        .drop("_salts")
    )
    if partition:
        salted_fact = salted_fact.repartition(*dealt)
    salted_dimension = dimension.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))
    ).drop(weight)
    if partition:
        salted_dimension = salted_dimension.hint("merge")
    joined = salted_fact.join(salted_dimension, [*keys, "_salt"], how)
    return joined if partition else joined.drop("_salt")


def _salts(weight: str, rows_per_salt: int) -> Column:
    """Number of salts of a key, at least one."""
    return F.expr(f"greatest(CAST(ceil({weight} / {rows_per_salt}) AS INT), 1)")


def _pick(spread_by: list[str], salts: Column) -> Column:
    return F.when(
        salts > 1, F.pmod(F.xxhash64(*spread_by), salts.cast("long")).cast("int")
    ).otherwise(0)
