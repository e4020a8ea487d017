"""What several test modules share."""

SMALL = "/root/testdata/sf0.001"


def _rows(df):
    cols = sorted(df.columns)
    rows = [
        tuple(v if isinstance(v, float) else str(v) for v in (r[c] for c in cols))
        for r in df.collect()
    ]
    # Text and whole numbers decide the order, so rounding noise does not.
    return sorted(
        rows,
        key=lambda r: (
            [v for v in r if not isinstance(v, float)],
            [round(v, 4) for v in r if isinstance(v, float)],
        ),
    )


def same(a, b):
    """Equal columns and equal rows in any order, doubles to six places."""
    assert sorted(a.columns) == sorted(b.columns)
    left, right = _rows(a), _rows(b)
    assert len(left) == len(right)
    for x, y in zip(left, right):
        for i, j in zip(x, y):
            if isinstance(i, float) and isinstance(j, float):
                assert abs(i - j) <= 1e-6 * max(1.0, abs(i)), (x, y)
            else:
                assert i == j, (x, y)
