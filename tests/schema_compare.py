"""Compare Spark result types with DuckDB result types for every query with oracle text."""

from __future__ import annotations

import sys

DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
                 "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "HUGEINT": "decimal(38,0)",
                 "FLOAT": "float", "SMALLINT": "smallint", "TINYINT": "tinyint"}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    sys.path.insert(0, ".")
    sys.path.insert(0, "tests")
    from oracle_compare import duck
    from tidecast.plans.registry import all_queries
    from tidecast.session import get_spark
    spark = get_spark("schema-check", {"spark.sql.shuffle.partitions": "8"}, master="local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name, (fn, sql) in all_queries().items():
        if not sql:
            continue
        s = {f.name.lower(): f.dataType.simpleString() for f in fn(spark, sf_dir).schema.fields}
        d = {r[0].lower(): DUCK_TO_SPARK.get(r[1], r[1]) for r in con.sql(f"DESCRIBE ({sql})").fetchall()}
        if s != d:
            bad += 1
            diff = {k: (s.get(k), d.get(k)) for k in set(s) | set(d) if s.get(k) != d.get(k)}
            print(name, diff, flush=True)
    print("schema mismatches:", bad)


if __name__ == "__main__":
    main(sys.argv)
