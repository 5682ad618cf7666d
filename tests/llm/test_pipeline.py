import os
import zlib

import pytest

import corpus_pipeline
from ticklake.llm.pii import Feistel, pseudonymized

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_stages_and_their_decisions(spark):
    from ticklake.llm.common import staged, table

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_near_dedup", "pii", "source_mixing", "byte_bpe"]
    docs = table(spark, SF, "documents")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = staged(stage(spark, docs, SF), f"test_{name}")
        rows = [tuple(r) for r in out.collect()]
        if name != "byte_bpe":
            assert out.columns == docs.columns
        seen.append((name, {r.doc_id: r for r in docs.collect()}, rows))
        docs = out
    (_, raw, clean), (_, _, single), (_, before, private), (_, _, mixed), (_, _, coded) = seen
    assert len(single) < len(clean) < len(raw)
    f = Feistel(corpus_pipeline.PSEUDONYM_KEY)
    assert len(private) == len(single) and all(r[1] == pseudonymized(before[r[0]].text or "", f)[0] for r in private)
    assert {r[0] for r in mixed} <= {r[0] for r in private}
    assert sorted(r[0] for r in coded) == sorted(r[0] for r in mixed)


def test_near_copies_go_and_clean_documents_stay(spark):
    words = lambda seed, n: [f"w{zlib.crc32(f'{seed}-{i}'.encode()) % 5000}" for i in range(n)]
    rows = []
    for i in range(20):
        text = words(i, 120)
        rows += [(10 * i, " ".join(text)), (10 * i + 1, " ".join([*text[:-1], "x"])), (10 * i + 2, " ".join(text))]
    rows += [(900, None), (901, ""), (902, "short text"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.one_of_each_group(spark, docs, SF)
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted([*range(0, 200, 10), 900, 901, 902, None], key=str)


def test_run_is_registered(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    ops = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in ops) == list(range(1, 14))
