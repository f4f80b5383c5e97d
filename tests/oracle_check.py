"""Run registered queries against their SQL in DuckDB and report differences."""

import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(base):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{base}/{t}.parquet')")
    return con


def _clean(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0
    if hasattr(v, "item"):
        return v.item()
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_clean(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, str(type(x)), x) if not isinstance(x, (int, float))
                                 else (x is None, "n", x) for x in r))
    return [names[i] for i in order], out


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "float": "FLOAT",
}


def compare(spark, con, base, query, sql):
    """Return (rows, list of problems)."""
    frame = query(spark, base)
    types = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    spark_names, spark_rows = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    described = [(d[0], str(d[1])) for d in cursor.description]
    sql_names, sql_rows = _rows([d[0] for d in described], cursor.fetchall())
    problems = []
    if spark_names != sql_names:
        return len(spark_rows), [f"columns {spark_names} != {sql_names}"]
    for name, kind in described:
        if KINDS.get(types[name], types[name]) != kind:
            problems.append(f"type of {name}: {types[name]} != {kind}")
    if len(spark_rows) != len(sql_rows):
        problems.append(f"rows {len(spark_rows)} != {len(sql_rows)}")
    bad = [(a, b) for a, b in zip(spark_rows, sql_rows) if a != b]
    if bad:
        columns = [n for i, n in enumerate(spark_names) if any(a[i] != b[i] for a, b in bad)]
        problems.append(f"{len(bad)} rows differ in {columns}; first:\n  {bad[0][0]}\n  {bad[0][1]}")
    return len(spark_rows), problems


def main(base, only=()):
    from __spark_entry__ import oracle_sql, queries
    from tillcast.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(base)
    sqls, failed = oracle_sql(), []
    for name, query in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in sqls:
                n, problems = compare(spark, con, base, query, sqls[name])
            else:
                n, problems = len(query(spark, base).collect()), []
        except Exception as error:  # report every query, not only the first failure
            n, problems = -1, [f"{type(error).__name__}: {str(error)[:1500]}"]
        status = "ok" if not problems else "FAIL"
        print(f"{status:5}{name:28}{n:>9} rows {time.time() - start:6.1f}s"
              f"{'' if name in sqls else '  (rows only)'}", flush=True)
        for p in problems:
            print("     ", p, flush=True)
        if problems:
            failed.append(name)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])))
