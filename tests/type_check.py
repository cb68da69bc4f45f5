"""Compare Spark and DuckDB column types per registered query.

Usage: ``python -m tests.type_check [sf_dir]``.
"""

import os
import sys

M = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
     "BooleanType": "BOOLEAN", "DateType": "DATE", "TimestampNTZType": "TIMESTAMP", "FloatType": "FLOAT",
     "ShortType": "SMALLINT", "ByteType": "TINYINT"}


def spark_type(dt) -> str:
    if dt.typeName() == "decimal":
        return f"DECIMAL({dt.precision},{dt.scale})"
    return M.get(type(dt).__name__, type(dt).__name__)


def main(sf: str) -> int:
    sys.path.insert(0, os.getcwd())
    from regiflow.plans import catalog
    from regiflow.session import get_session
    from tests.oracle_compare import duck
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf)
    q, o = catalog.queries(), catalog.oracle_sql()
    bad = 0
    for n in sorted(o):
        st = {f.name: spark_type(f.dataType) for f in q[n](spark, sf).schema.fields}
        dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE {o[n]}").fetchall()}
        diff = {c: (st[c], dt.get(c)) for c in st if st[c] != dt.get(c)}
        if diff:
            bad += 1
            print(n, diff)
    print("queries with type differences:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"))
