"""The documents of a folder, for plain Python."""

import pyarrow.parquet as pq


def documents(sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return [(i, t or "") for i, t in zip(table["doc_id"], table["text"])]
