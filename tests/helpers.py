from collections import Counter


def bag(df, cols=None):
    cols = cols or sorted(df.columns)
    return Counter(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def assert_same(a, b, cols=None):
    cols = cols or sorted(a.columns)
    ba, bb = bag(a, cols), bag(b, cols)
    assert ba == bb, f"differ: only-left={list((ba - bb).items())[:3]} only-right={list((bb - ba).items())[:3]}"
