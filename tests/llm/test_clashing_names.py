"""Columns of a caller keep their values, whatever operators call their own."""

import subprocess
import sys
import textwrap
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ticklake.llm.mixing import mixed_documents, mixture
from ticklake.llm.pii import Feistel, pseudonymized

SF = "/root/testdata/sf0.001"
NAMES = ["base", "threshold", "size", "target", "taken", "source_size", "digest", "found", "score", "predicted", "held_out", "hash", "words", "budget", "of", "prefix", "component", "kept", "row", "id"]


@pytest.fixture
def documents(spark):
    rows = [(i, f"text of {i % 40} numbers {i}, call 212-555-{1000 + i}", "en", f"s{i % 3}", 5) for i in range(60)] + [(100, None, None, None, None), (3, "", "en", "s0", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.concat(F.lit(name), F.col("doc_id").cast("string")).alias(name) for name in NAMES])


def own(rows):
    return all(r[name] == f"{name}{r.doc_id}" for r in rows for name in NAMES)


@pytest.mark.parametrize("stage", [s for n, s in corpus_pipeline.STAGES if n != "byte_bpe"])
def test_stages_keep_the_columns_of_documents(spark, documents, stage):
    out = stage(spark, documents, SF)
    rows = out.collect()
    assert out.columns == documents.columns and rows and own(rows)


def test_mixing_keeps_other_columns(documents):
    rows = mixed_documents(documents).collect()
    assert len(rows) >= 60 and own(rows)
    rows = mixture(documents).collect()
    replaced = ("size", "source_size", "target", "taken")
    assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in NAMES if n not in replaced) and len({r["size"] for r in rows}) == 2


def test_many_digit_groups_take_time_in_proportion():
    f = Feistel(b"key")
    seconds = []
    for n in (25_000, 200_000):  # the longer one has 1 MB
        text = " ".join(f"{(i * 7919) % 10_000:04d}" for i in range(n))
        start = time.process_time()
        new, counts = pseudonymized(text, f)
        seconds.append(time.process_time() - start)
        assert counts["card"] > n / 100 and len(new) == len(text)
    assert seconds[1] < 8 * 2 * seconds[0]


def test_queries_load_without_a_library_of_the_operators():
    code = """
        import sys
        sys.modules["public_tokenizers"] = None  # importing it fails
        sys.path.insert(0, ".")
        import __spark_entry__ as entry
        names = list(entry.queries())
        assert "gold_volatility" in names and not any(n.startswith("op") or n == "pipeline" for n in names)
        assert set(entry.oracle_sql()) <= set(names)
    """
    top = corpus_pipeline.__file__.rsplit("/", 1)[0]
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True, cwd=top, timeout=120)
