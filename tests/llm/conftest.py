import random

import pytest

WORDS = [a + b + c for a in ("ta", "re", "mi", "so", "lu", "ne") for b in ("ka", "do", "vi", "pe") for c in ("n", "s", "r")]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) * (r.random() < 0.5) for _ in range(n))


LONG = prose(1, 20_000)
LINE = "This line of more than forty characters stands in many documents."


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, copies, a repeated row,
    and further columns whose names clash with the operators' own."""
    a, b = prose(2, 120), prose(3, 80)
    near = a.replace(a.split()[60], "changed", 1)
    rows = [(0, None), (1, ""), (2, " \t\n\r"), (3, "word"), (4, LONG), (5, a), (6, a.upper()), (7, near), (8, b), (8, b),
            (None, a), (None, None), (9, f"{LINE}\n{b}\nend"), (10, f"x\n  {LINE.upper()}\t"), (11, LINE), (12, LINE),
            (13, f"{LINE}\n{LINE}"), (14, "### $$ 1 2 3 " * 20)]
    rows = [(i, t, "xx" if k % 3 else None, None if k % 4 == 0 else "src", None if t is None else len(t), k, "own", True,
             7, b"raw", 0.5) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id long, "
                                       "label string, kept boolean, n_lines long, filter binary, key double")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


def same(got, want):
    """Equal rows in any order (columns by name)."""
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = lambda df: sorted(map(str, df[cols].astype(object).where(df[cols].notna(), None).itertuples(index=False, name=None)))
    assert key(got) == key(want)
