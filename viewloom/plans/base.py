"""Stand-in inputs over the driver tables.  Each is one SELECT that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

BASES = {
    "images": "SELECT DISTINCT CAST(label AS BIGINT) AS image_id FROM {embeddings}",
    "frames": "SELECT CAST(s_suppkey AS BIGINT) - (SELECT min(s_suppkey) FROM {supplier}) AS image_id FROM {supplier}",
    "photos": "SELECT CAST(p_partkey AS BIGINT) AS image_id, 600 + 40 * p_size AS width, 560 + CAST(p_partkey % 7 AS INT) * 90 AS height FROM {part}",
    "points": "SELECT CAST(l_suppkey AS BIGINT) AS image_id, CAST(l_orderkey AS BIGINT) * 1000000000000 + CAST(l_linenumber AS BIGINT) * 100000000000 + CAST(round(l_extendedprice * 100) AS BIGINT) * 100 + l_partkey % 100 AS pos, CAST(l_partkey % 640 AS DOUBLE) + l_discount * 16 AS x, CAST(l_orderkey % 480 AS DOUBLE) + l_tax * 16 AS y, CAST(l_partkey % 640 AS BIGINT) + 640 * CAST(l_orderkey % 480 AS BIGINT) AS pix FROM {lineitem}",
    "edges": "SELECT CAST(o_custkey % 40 AS BIGINT) AS src, CAST(o_orderkey % 37 AS BIGINT) AS dst, CAST(o_orderkey AS BIGINT) AS pos FROM {orders}",
    "raw": "SELECT CAST(l_suppkey % 7 AS BIGINT) AS src, CAST(7 + l_partkey % 5 AS BIGINT) AS dst, CAST(l_orderkey AS BIGINT) * 1000000000000 + CAST(l_linenumber AS BIGINT) * 100000000000 + CAST(round(l_extendedprice * 100) AS BIGINT) * 100 + l_partkey % 100 AS pos, CAST(l_partkey % 97 AS BIGINT) AS pix1, CAST(l_orderkey % 89 AS BIGINT) AS pix2, 1 + l_quantity / 10 AS conf1, 1 + l_discount * 20 AS conf2, 1 + l_quantity / 10 AS conf FROM {lineitem}",
    "confs": "SELECT CAST(l_suppkey % 9 AS BIGINT) AS src, CAST(l_partkey % 8 AS BIGINT) AS dst, 1 + l_quantity / 50 AS c11, 1 + l_discount AS c21, 1 + l_tax AS c22, 2 + l_quantity / 100 AS c12, l_extendedprice / 1000 AS conf FROM {lineitem}",
    "views": "SELECT CAST(l_suppkey % 10 AS BIGINT) AS image_id, CAST(l_partkey % 6 AS BIGINT) AS other_id, CAST(l_orderkey % 500 AS BIGINT) AS pix, l_extendedprice / 1000 AS x3, l_quantity AS y3, 1 + l_discount * 30 AS z3, 1 + l_tax * 10 AS conf FROM {lineitem}",
    "depths": "SELECT CAST(l_suppkey % 10 AS BIGINT) AS image_id, CAST(l_partkey % 64 AS BIGINT) AS x, CAST(l_orderkey % 48 AS BIGINT) AS y, 64 AS width, avg(l_quantity) AS depth FROM {lineitem} GROUP BY 1, 2, 3",
    "cameras": "SELECT CAST(c_custkey AS BIGINT) AS image_id, 500 + c_acctbal / 100 AS focal, CAST(c_nationkey AS DOUBLE) AS cx, CAST(c_custkey % 100 AS DOUBLE) AS cy, 1 + CAST(c_custkey % 13 AS DOUBLE) AS conf_sum FROM {customer}",
    "samples": "SELECT CAST(l_partkey AS BIGINT) AS point_id, l_quantity AS depth, 25 + l_discount * 100 AS projected, l_tax * 10 AS conf, l_linenumber % 3 <> 0 AS inside FROM {lineitem}",
    "triples": "SELECT CAST(l_partkey AS BIGINT) AS key, CASE WHEN l_linenumber % 4 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_quantity END AS x, l_extendedprice / 100 AS y, l_discount * 7 AS z, 1 + l_tax * 10 AS conf FROM {lineitem}",
    "observed": "SELECT CAST(l_orderkey AS BIGINT) AS track_id, CAST(l_suppkey AS BIGINT) AS image_id, CAST(l_linenumber AS BIGINT) AS idx, CAST(l_orderkey AS BIGINT) * 1000000000000 + CAST(l_linenumber AS BIGINT) * 100000000000 + CAST(round(l_extendedprice * 100) AS BIGINT) * 100 + l_partkey % 100 AS pos, CAST(l_partkey % 700 AS BIGINT) AS pix, l_quantity AS x, l_extendedprice / 100 AS y, l_discount * 10 AS z, 45 AS width, 700 AS height, CAST(l_partkey % 256 AS INT) AS r, CAST(l_suppkey % 256 AS INT) AS g, CAST(l_orderkey % 256 AS INT) AS b FROM {lineitem}",
    "sims": "SELECT CAST(a.vec_id AS BIGINT) AS i, CAST(b.vec_id AS BIGINT) AS j, a.embedding AS va, b.embedding AS vb, a.label AS li, b.label AS lj FROM {embeddings} a CROSS JOIN {embeddings} b",
    "local_feats": "SELECT CAST(label AS BIGINT) AS image_id, CAST(vec_id AS BIGINT) AS pos, 1 + CAST((vec_id * 7919) % 101 AS DOUBLE) / 10 AS attn, embedding AS feat FROM {embeddings}",
    "scored": "SELECT CAST(o_custkey AS BIGINT) AS query_id, CAST(o_orderkey AS BIGINT) AS item, o_totalprice AS score, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM {orders}",
    "rig": "SELECT CAST(s_suppkey AS BIGINT) AS image_id, s_acctbal / 100 AS x, CAST(s_nationkey AS DOUBLE) AS y, CAST(s_suppkey % 17 AS DOUBLE) AS z FROM {supplier}",
    "cover": "SELECT CAST(s_suppkey % 12 AS BIGINT) AS row, CAST(s_nationkey AS BIGINT) AS col, sum(abs(s_acctbal)) AS w FROM {supplier} GROUP BY 1, 2",
    "dist": "SELECT CAST(a.s_suppkey AS BIGINT) AS i, CAST(b.s_suppkey AS BIGINT) AS j, abs(a.s_acctbal - b.s_acctbal) / 20000 AS d FROM {supplier} a CROSS JOIN {supplier} b",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in as a DataFrame."""
    text = BASES[name]
    return spark.sql(text, **{t: read(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text})


def sql(names: str, body: str) -> str:
    """SQL with the named stand-ins in front."""
    parts = ", ".join(f"{n} AS ({BASES[n].format(**{t: t for t in TABLES})})" for n in names.split())
    head = "WITH RECURSIVE " if "UNION SELECT" in body else "WITH "
    return f"{head}{parts}{', ' + body if body.lstrip().split(None, 1)[0] != 'SELECT' else ' ' + body}"


def rounded(df: DataFrame, digits: int = 6, **kept) -> DataFrame:
    """df with its double columns rounded."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
