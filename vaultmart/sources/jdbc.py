"""JDBC source and sink for the CRM tables.

Reads are partitioned on a column range so several tasks pull in parallel;
writes replace the table's rows with a truncate (dependent views survive)
in one bulk Spark write, or in one transaction (:func:`reload_table`).  Connection settings are a plain dict.

:func:`read_split` needs no bounds from the caller.  It measures them in the database: least and greatest
value of a number, date or timestamp; of a text column the counts of its prefixes, refined where one holds
too much, so that ids like UUIDs, or numbers written as text, part into reads of like size.  Only prefixes
and counts reach the driver, a bounded number of them.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

DERBY_DRIVER = "org.apache.derby.jdbc.EmbeddedDriver"


def embedded_url(label: str) -> str:
    """An in-memory embedded Derby database (same JVM only; tests)."""
    name = hashlib.md5(label.encode()).hexdigest()[:16]
    return f"jdbc:derby:memory:vm{name};create=true"


def connection_properties(url: str, user: str | None = None, password: str | None = None,
                          driver: str | None = None) -> dict[str, str]:
    props = {}
    if user:
        props["user"] = user
    if password:
        props["password"] = password
    if driver or url.startswith("jdbc:derby:"):
        props["driver"] = driver or DERBY_DRIVER
    return props


def settings_from_env(prefix: str = "VAULTMART_JDBC_") -> tuple[str, dict[str, str]]:
    """URL and connection properties from ``<prefix>URL``, ``USER``, ``PASSWORD``,
    ``DRIVER`` (S4); missing optional ones are left out."""
    url = os.environ[f"{prefix}URL"]
    return url, connection_properties(url, os.environ.get(f"{prefix}USER"),
                                      os.environ.get(f"{prefix}PASSWORD"),
                                      os.environ.get(f"{prefix}DRIVER"))


def write_table(df: DataFrame, url: str, table: str, properties: dict | None = None,
                connections: int = 16) -> None:
    """Replace the table's rows (truncate + bulk insert; create if missing).

    At most ``connections`` tasks write at once.  Truncate and inserts are separate
    transactions: a reader in between sees fewer rows, and a failed write is run again."""
    props = properties or connection_properties(url)
    (df.write.option("numPartitions", str(connections)).mode("overwrite").option("truncate", "true")
       .jdbc(url, table, properties=props))


def read_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               lower=None, upper=None, partitions: int = 1,
               properties: dict | None = None, fetch_size: int = 10_000) -> DataFrame:
    """Read a table, split into ``partitions`` ranges of ``partition_column``."""
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("preferTimestampNTZ", "true").option("fetchsize", str(fetch_size)))
    for key, value in (properties or connection_properties(url)).items():
        reader = reader.option(key, value)
    if partition_column is not None:
        # numeric, date or timestamp column; bounds only shape the ranges
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower)).option("upperBound", str(upper))
                  .option("numPartitions", str(partitions)))
    return reader.load()


def read_split(spark: SparkSession, url: str, table: str, column: str, partitions: int = 4,
               properties: dict | None = None, fetch_size: int = 10_000) -> DataFrame:
    """Read a table in ``partitions`` tasks of like size, split on ``column`` by what the database says of it.

    Rows with a null in the column are read too (with a text column by the first task)."""
    props = properties or connection_properties(url)
    actual, kind = next((n, k) for n, k in read_table(spark, url, table, properties=props).dtypes if n.lower() == column.lower())
    name = _quoted(spark, url, actual)
    if kind != "string":
        low, high = _query(spark, url, props, f"SELECT MIN({name}) AS least, MAX({name}) AS most FROM {table}").first()
        if low is None:
            return read_table(spark, url, table, properties=props, fetch_size=fetch_size)
        return read_table(spark, url, table, actual, low, high, partitions, props, fetch_size)
    predicates = text_predicates(lambda sql: [tuple(r) for r in _query(spark, url, props, sql).collect()], table, name, partitions)
    options = {**props, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true"}
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


def _quoted(spark: SparkSession, url: str, name: str) -> str:
    return spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(name)


def _query(spark: SparkSession, url: str, props: dict, sql: str) -> DataFrame:
    return spark.read.format("jdbc").option("url", url).option("query", sql).options(**props).load()


DEEPEST = 12   # characters of a prefix at most


def text_predicates(ask, table: str, name: str, partitions: int) -> list[str]:
    """Disjoint conditions that together hold for every row: prefixes of like total counts.

    ``ask(sql)`` returns the rows ``(prefix, count)`` of a statement.  A prefix with more than a quarter of a
    task's share is parted by its next character.  What no measured prefix covers (nulls, rows that come
    in between) belongs to the first condition."""
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def prefix(depth: int) -> str:  # cast: a database may hold text as a large object, which it does not compare
        return f"CAST(SUBSTR({name}, 1, {depth}) AS VARCHAR({depth}))"

    def counts(depth: int, within: str | None) -> list[tuple[str, int]]:
        where = f"{name} IS NOT NULL" if within is None else f"{prefix(depth - 1)} = {quoted(within)}"
        return ask(f"SELECT p, COUNT(*) AS n FROM (SELECT {prefix(depth)} AS p FROM {table} WHERE {where}) t GROUP BY p")

    def is_one_of(depth: int, prefixes: list[str]) -> str:
        return f"{prefix(depth)} IN ({', '.join(map(quoted, prefixes))})"

    first = counts(1, None)
    if not first:
        return ["1 = 1"]
    most = max(1, sum(n for _, n in first) // (4 * partitions))
    leaves, rest, level, depth = [], [f"{name} IS NULL", f"NOT ({is_one_of(1, [p for p, _ in first])})"], first, 1
    while level:
        heavy = [p for p, n in level if n > most and depth < DEEPEST and len(p) == depth]
        leaves += [(n, depth, p) for p, n in level if p not in heavy]
        level, depth = [], depth + 1
        for p in heavy:
            below = counts(depth, p)
            rest.append(f"{prefix(depth - 1)} = {quoted(p)}" + (f" AND NOT ({is_one_of(depth, [x for x, _ in below])})" if below else ""))
            level += below
    bins = [(0, k, []) for k in range(partitions)]
    for n, depth, p in sorted(leaves, reverse=True):  # the largest first, each into the emptiest
        load, k, held = heapq.heappop(bins)
        heapq.heappush(bins, (load + n, k, [*held, (depth, p)]))
    out = []
    for _, _, held in sorted(bins, key=lambda b: -b[0]):
        by_depth: dict[int, list[str]] = {}
        for depth, p in held:
            by_depth.setdefault(depth, []).append(p)
        if held:
            out.append(" OR ".join(is_one_of(d, ps) for d, ps in sorted(by_depth.items())))
    out[0] = " OR ".join([out[0], *(f"({r})" for r in rest)])
    return out


def reload_table(df: DataFrame, url: str, table: str, properties: dict | None = None, connections: int = 16) -> None:
    """Replace the table's rows so that readers see the old rows or the new ones, never fewer.

    Spark loads a shadow table in bulk, which no reader knows; then one transaction deletes the old rows and
    takes the shadow's over, inside the database.  A load that fails leaves the old rows; the table itself stays, with its
    views and rights.  A missing table is made by the load."""
    spark, props = df.sparkSession, properties or connection_properties(url)
    shadow = f"{table}_{uuid.uuid4().hex[:8]}"
    connection = _connect(spark, url, props)
    try:
        if not _has_table(connection, table):
            df.limit(0).write.jdbc(url, table, properties=props)
        try:
            df.write.option("numPartitions", str(connections)).mode("overwrite").jdbc(url, shadow, properties=props)
            names = ", ".join(_quoted(spark, url, c) for c in df.columns)
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            try:
                statement.executeUpdate(f"DELETE FROM {table}")
                statement.executeUpdate(f"INSERT INTO {table} ({names}) SELECT {names} FROM {shadow}")
                connection.commit()
            except BaseException:
                connection.rollback()
                raise
            finally:
                statement.close()
        finally:
            connection.setAutoCommit(True)
            if _has_table(connection, shadow):
                statement = connection.createStatement()
                statement.executeUpdate(f"DROP TABLE {shadow}")
                statement.close()
    finally:
        connection.close()


def _connect(spark: SparkSession, url: str, props: dict):
    jvm = spark.sparkContext._jvm
    if "driver" in props:
        jvm.java.lang.Class.forName(props["driver"])
    settings = jvm.java.util.Properties()
    for key, value in props.items():
        settings.setProperty(key, value)
    return jvm.java.sql.DriverManager.getConnection(url, settings)


def _has_table(connection, table: str) -> bool:
    statement = connection.createStatement()
    try:
        statement.executeQuery(f"SELECT 1 FROM {table} WHERE 1 = 0").close()
        return True
    except Exception as e:  # the database's own "no such table"
        if "SQLException" not in str(getattr(e, "java_exception", "")) and "SQLSyntax" not in str(e):
            raise
        return False
    finally:
        statement.close()
