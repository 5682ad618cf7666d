import pytest

from ticklake.llm.suffix_dedup import repeated_passages


def words(seed, n):
    return " ".join(f"{seed}{i}" for i in range(n))


A, B = words("a", 60), words("b", 60)


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        # 2 has a copy of 1 and another text, which 3 repeats
        ([(1, A), (2, A), (2, B), (3, "x " + B)], {(1, 0, 60), (2, 0, 60), (3, 1, 61)}),
        # the smallest id has another text too: it isn't of its copy
        ([(1, A), (1, words("c", 70) + " " + B), (2, A), (3, B)], {(1, 0, 60), (1, 70, 130), (2, 0, 60), (3, 0, 60)}),
        # what stands in two texts of an id stands in the copy of one of them
        ([(1, A), (1, words("c", 80) + " " + A), (2, A), (4, A)], {(1, 0, 60), (1, 80, 140), (2, 0, 60), (4, 0, 60)}),
    ],
)
def test_ids_with_several_texts(docs, rows, expected):
    out = repeated_passages(docs(rows)).collect()
    assert {(r.doc_id, r.start_word, r.end_word) for r in out} == expected and len(out) == len(expected)
