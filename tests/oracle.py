"""Compare a registered query with its SQL on the same Parquet tables."""

import math
import os
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Spark's type names under the names the oracle uses.
_SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(sf_dir, table)}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return format(value, "f")
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(con, df, sql):
    """Returns a list of differences, empty if rows, names and types agree."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    want_types = {r[0]: r[1] for r in described}
    have_types = {
        f.name: _SAME.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) for f in df.schema.fields
    }
    problems = []
    if {k: v.replace(" ", "") for k, v in want_types.items()} != {k: v.replace(" ", "") for k, v in have_types.items()}:
        problems.append(f"types: oracle {want_types}, spark {have_types}")
    want = _rows([r[0] for r in described], con.execute(sql).fetchall())
    have = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(want) != len(have):
        problems.append(f"rows: oracle {len(want)}, spark {len(have)}")
    bad = [(w, h) for w, h in zip(want, have) if w != h]
    if bad:
        problems.append(f"values: {len(bad)} differ, first oracle {str(bad[0][0])[:300]}, spark {str(bad[0][1])[:300]}")
    return problems
