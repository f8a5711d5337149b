"""A passage that one block of 32 words holds is found wherever it starts."""

from viewloom.llm import licenses


def test_blocks_begin_anywhere(spark):
    t = dict(licenses.TEMPLATES)["apache-2-text"].split()
    rows = [(i, " ".join(["x"] * i + t[:4] + ["y"] * 7 + t[4:])) for i in range(32)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 32 and all("apache-2-text" in r.labels.split(",") for r in found)


def test_long_templates_from_a_table(spark):
    """A template longer than the default block is found whole, with words put in, and not when too few words stand."""
    long = [f"t{i}" for i in range(60)]
    templates = spark.createDataFrame([("long", " ".join(long).upper()), ("short", "one, two"), (None, "x"), ("none", None), ("empty", "--")], "label string, text string")
    texts = ["a b " + " ".join(long), " ".join(w for t in long for w in (t, "z")), " ".join(long[:40]), "one and two", "one", None]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, labels string"), templates=templates).collect()
    assert {r.doc_id: r.labels for r in found} == {0: "long", 1: "long", 2: "", 3: "short", 4: "", 5: ""}
