import random

import pytest

from warraq.llm import splitting


def rules(pieces, length, limit, overlap, most):
    pieces = sorted(pieces)
    assert [p[0] for p in pieces] == list(range(len(pieces)))
    assert pieces[0][1] == 0 and pieces[-1][2] == length
    for _, a, b in pieces:
        assert 0 < b - a <= limit
    for (_, a, b), (_, c, e) in zip(pieces, pieces[1:]):
        assert overlap <= b - c <= overlap + most and c > a and e > b


def greedy(bounds, length, limit, overlap):
    """The same cuts, one after another. bounds: {pos: grade}."""
    out, p = [], 0
    while True:
        if length - p <= limit:
            return [*out, (len(out), p, length)]
        end = max((g, q) for q, g in bounds.items() if p + limit // 2 < q <= p + limit)[1]
        out.append((len(out), p, end))
        p = max(q for q in bounds if q <= end - overlap)


def test_text_pieces(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ابتجد") for _ in range(rng.randrange(1, 9)))
    texts = {}
    for i in range(12):
        texts[i] = " ".join(word() + rng.choice(["", "", "", ".", "،", ".\n"]) for _ in range(rng.randrange(50, 3000)))
    texts[20], texts[21], texts[22], texts[23], texts[24] = "x" * 9000, "a" * 1500, "a" * 1501, None, ""
    texts[25] = "word " * 100_000
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in texts.items()] + [(20, texts[20], "d", 2), (None, texts[20], "e", 3)], "id bigint, text string, pos string, grade int")
    got = {}
    for r in splitting.split_texts(df).collect():
        assert r.piece == texts[r.id][r.start : r.end]
        got.setdefault(r.id, []).append((r.piece_no, r.start, r.end))
    assert set(got) == {i for i, t in texts.items() if t and len(t) > 1500}
    for i, pieces in got.items():
        rules(pieces, len(texts[i]), 1500, 100, 50)
    first = sorted(got[0]) if 0 in got else []
    for _, _, b in first[:-1]:
        assert texts[0][b - 1].isspace()


def test_doubling_equals_walking(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for item in range(8):
        length = rng.randrange(30, 2000)
        bounds = {0: 5, length: 5}
        p = 0
        while p < length:
            bounds.setdefault(p, rng.randrange(0, 4))
            p += rng.randrange(1, 4)
        rows += [(item, q, g, length) for q, g in bounds.items()] * 2
        want[item] = greedy(bounds, length, 20, 4) if length > 20 else None
    got = {}
    for r in splitting.cut_pieces(spark.createDataFrame(rows, "item_key bigint, pos bigint, grade int, length bigint"), 20, 4).collect():
        got.setdefault(r.item_key, []).append((r.piece_no, r.start, r.end))
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}


def test_page_ranges(spark):
    df = spark.createDataFrame(
        [(1, "s", 1, 8, "z"), (2, "s", 1, 9, "z"), (3, "s", 5, 40, "z"), (3, "s", 5, 40, "z"), (4, "s", None, 9, "z"), (5, "s", 30, 2, "z"), (6, None, 1, 20, "z")],
        "id bigint, source string, from_page int, to_page int, length string",
    )
    pages = spark.createDataFrame([("s", 12, 0, "عنوان"), ("s", 12, 1, "نص."), ("s", 20, 0, None)], "source string, web_page int, para_idx int, text string")
    got = {}
    for r in splitting.split_page_ranges(df, splitting.page_grades(pages)).collect():
        got.setdefault(r.id, []).append((r.piece_no, r.from_page, r.to_page))
    assert set(got) == {2, 3, 6}
    assert sorted(got[3])[0] == (0, 5, 11)  # page 12 begins with a heading: the best cut within reach is before it
    for i, (a, b) in {2: (1, 9), 3: (5, 40), 6: (1, 20)}.items():
        rules([(k, f - a, t - a + 1) for k, f, t in got[i]], b - a + 1, 8, 1, 0)


def test_empty_and_bad_parameters(spark):
    assert splitting.split_texts(spark.createDataFrame([], "id bigint, text string")).count() == 0
    with pytest.raises(ValueError):
        splitting.cut_pieces(spark.createDataFrame([], "item_key bigint, pos bigint, grade int, length bigint"), 10, 5)
