"""Perspective rotation against a plain loop."""

import pytest

from skytally.llm.chat_format import Template, rotate

T = Template()
SCHEMA = "conv_id long, turn long, role string, text string"


def first_null(x):
    return tuple((v is not None, v if v is not None else "") for v in x)


def brute(rows, chunk):
    out = []
    convs = {r[0] for r in rows}
    for conv in convs:
        said = sorted({r[1:] for r in rows if r[0] == conv}, key=first_null)
        for who in {r for _, r, _ in said if r not in (None, "system")}:
            parts = {}
            for turn, role, text in said:
                mark = T.assistant if role == who else T.system if role == "system" else T.user + (role or "") + T.after_name
                parts.setdefault(-1 if turn is None else turn // chunk, []).append((role == who, mark, (text or "") + T.end))
            for c, ps in parts.items():
                whole, mask = "", []
                for own, mark, body in ps:
                    whole += mark
                    if own:
                        mask.append((len(whole), len(whole) + len(body)))
                    whole += body
                out.append((conv, who, c, len(ps), len(mask), whole, tuple(mask)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.conv_id, r.perspective, r.chunk, r.n_turns, r.n_trained, r.text, tuple(tuple(m) for m in r.mask)) for r in df.collect()), key=str)


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi, 😀 é"), (1, 2, "bob", "Hello\nann"), (1, 3, "cat", ""), (1, 4, "ann", None), (1, 4, "ann", "b"), (1, 4, "ann", "b"),
    (2, None, "ann", "x"), (2, 5, None, "nobody"), (2, 1, "bob", "y"), (None, 1, "ann", "no id"), (None, 2, "bob", "no id"), (3, 0, "system", "alone"), (4, 0, None, None),
    (5, 0, "user", "a" * 5000), *((6, i, "ann" if i % 2 else "bob", f"t{i}") for i in range(30)),
]


@pytest.mark.parametrize("chunk", [512, 7])
def test_equals_loop(spark, chunk):
    df = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 AS chunk", "'x' AS perspective", "2 AS stop", "3 AS mask")
    assert got(rotate(df, chunk=chunk)) == brute(ROWS, chunk)


def test_empty_table(spark):
    assert rotate(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("most_bytes", [1 << 26, 300])
def test_rows_are_bounded_without_turn_numbers(spark, most_bytes):
    rows = [(c, t, ("ann", "bob", "system", None)[i % 4], f"{i * 37 % 100} " + "é" * (i % 50)) for c in (None, 1) for t in (None, 3) for i in range(100)] + [(2, 1, "ann", "x"), (None, 4, "cat", None)]
    parts = rotate(spark.createDataFrame(rows, SCHEMA).repartition(5), chunk=7, most_bytes=most_bytes).collect()
    assert max(r.n_turns for r in parts) <= 7 and max(len(r.text.encode()) for r in parts) <= most_bytes + 200
    assert len({(r.conv_id, r.perspective, r.chunk, r.part) for r in parts}) == len(parts) > 100
    whole = {}
    for r in sorted(parts, key=lambda r: r.part):
        n, trained, text, mask = whole.get((r.conv_id, r.perspective, r.chunk), (0, 0, "", ()))
        mask += tuple((len(text) + a, len(text) + b) for a, b in r.mask)
        whole[r.conv_id, r.perspective, r.chunk] = n + r.n_turns, trained + r.n_trained, text + r.text, mask
    assert sorted(((*k, *v) for k, v in whole.items()), key=str) == brute(rows, 7)
