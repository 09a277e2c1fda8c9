"""Line deduplication against brute force, with buckets dealt into several blocks."""

import numpy as np
import pyarrow as pa
import pytest

from fleetbook.llm import lines, linking
from fleetbook.llm.tables import prepare


def _expected(rows):
    """Places of the lines that go, by document: all pairs of lines, on full sets."""
    found = [(i, p, x.strip()) for i, text in rows for p, x in enumerate(text.split("\n")) if len(x.strip()) >= 8]
    names = sorted({x for _, _, x in found})
    sets = {x: {x[k:k + 8] for k in range(len(x) - 7)} for x in names}
    root = {x: x for x in names}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, x in enumerate(names):
        for y in names[:k]:
            if 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                root[top(x)] = top(y)
    gone, seen = {i: [] for i, _ in rows}, set()
    for i, p, x in sorted(found):
        if top(x) in seen:
            gone[i].append(p)
        seen.add(top(x))
    return gone


@pytest.mark.parametrize("tile", [linking.TILE, 8])
def test_lines_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(linking, "TILE", tile)
    rng, pool = np.random.default_rng(11), []
    shared = "".join(rng.choice(list("abcdefgh ij"), 150))
    for k in range(60):
        # A common beginning puts lines of different components into the same buckets.
        base = list(shared + "".join(rng.choice(list("klmnop qrst"), 60)) if k % 2 else "".join(rng.choice(list("uvwxyz é中"), 160)))
        for _ in range(4):
            line = list(base)
            for at in rng.integers(0, len(line), rng.integers(0, 2)):
                line[at] = "#"
            pool.append("".join(line).strip())
    order = rng.permutation(len(pool))
    rows = [(int(i), "\n".join(("  " if j % 3 else "") + pool[j] for j in order[i * 8:i * 8 + 8]) + "\nshort\n") for i in range(30)]
    got = {r["doc_id"]: r["dropped"] for r in lines.decisions(prepare(spark).createDataFrame(rows, "doc_id long, text string")).collect()}
    want = _expected(rows)
    assert sum(map(len, want.values())) > 100 and got == want


def test_lines_are_cut_and_trimmed_as_python_does():
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list(" \n\tab\ré中x"), rng.integers(0, 120))) for _ in range(300)]
    texts += [None, "", " " * 100, "\n" * 9, " " * 60 + "abcdefghij" + " " * 70 + "\nabcdefghij", "abcdefgh"]
    raw, starts, ends, row, place = lines.lines_of(pa.array(texts, pa.string()))
    got = [(r, p, raw[a:b].tobytes().decode()) for r, p, a, b in zip(row.tolist(), place.tolist(), starts.tolist(), ends.tolist())]
    space = " \t\n\x0b\x0c\r"
    assert got == [(r, p, x.strip(space)) for r, t in enumerate(texts) for p, x in enumerate((t or "").split("\n")) if x.strip(space)]
