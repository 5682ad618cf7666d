import corpus_pipeline


def text(seed, n=60):
    return " ".join(f"w{seed}x{i}" for i in range(n))


def test_rows_that_repeat_an_id_are_decided_on_one_by_one(spark):
    near = lambda t: t + " more"
    rows = [
        (1, text(1)), (1, text(1)), (2, near(text(1))),  # equal rows of the smallest id
        (3, text(3)), (3, near(text(3))), (4, text(3)),  # near copies with one id
        (5, text(5)), (6, text(5)), (6, text(6)),  # a copy, and another text of its id
        (7, text(7)), (7, text(70)), (8, text(7)), (9, text(70)),  # two groups with one smallest id
        (10, ""), (10, ""), (11, None), (11, None), (None, text(1)), (None, text(1)),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert out.columns == docs.columns
    left = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    three = [x for x in left if x[0] == 3]
    assert len(three) == 1 and three[0] in rows
    expected = [(1, text(1)), (5, text(5)), (6, text(6)), (7, text(7)), (7, text(70)), *rows[-6:]]
    assert [x for x in left if x[0] != 3] == sorted(expected, key=str)
