import hashlib
import random

import numpy as np
import pytest

from tests.llm import brute, cases
from tilewright.llm import suffix_dedup as S


def compare(rows, out):
    got = {r.doc_id: r for r in out}
    for i, flags in brute.repeats(rows).items():
        b = (dict(rows)[i] or "").encode()
        kept = bytes(x for x, f in zip(b, flags, strict=True) if not f)
        starts = sum(1 for k in range(len(flags)) if flags[k] and (k == 0 or not flags[k - 1]))
        r = got[i]
        assert (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) == (len(b), sum(flags), starts, hashlib.sha256(kept).hexdigest()), i


def corpus(seed):
    rng = random.Random(seed)
    blocks = ["".join(rng.choice("abcé ") for _ in range(rng.randrange(80, 260))) for _ in range(8)]
    rows = []
    for i in range(60):
        parts = [rng.choice(blocks) if rng.random() < 0.5 else "".join(rng.choice("xyz ") for _ in range(rng.randrange(0, 120))) for _ in range(rng.randrange(0, 6))]
        rows.append((i * 3, "".join(parts)))
    rows += [(1000, None), (1001, ""), (1002, "a" * 700), (1003, "ab" * 300), (1004, "z" * 99), (1005, "z" * 101), (1006, rows[5][1])]
    return rows


@pytest.mark.parametrize("chunk", [S.CHUNK, 3])
def test_against_brute_force(spark, chunk):
    rows = corpus(chunk)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    compare(rows, S.remove_repeats(df, chunk=chunk).collect())


def test_deep_shallow_sorts():
    rng = random.Random(3)
    text = bytes(rng.choice(b"ab") for _ in range(400)) * 3 + b"ab" * 200
    starts = np.arange(len(text) - S.LENGTH + 1)
    group = starts % 2
    order, classes = S.deep_shallow(text, starts, group)
    want = sorted(starts, key=lambda s: (s % 2, text[s : s + S.LENGTH]))
    cut = lambda s: (s % 2, text[s : s + S.LENGTH])
    assert [cut(s) for s in order] == [cut(s) for s in want]
    seen = {}
    for s in starts:
        assert seen.setdefault(cut(s), classes[s]) == classes[s]
    assert len(set(classes.tolist())) == len(seen)


def test_multikey_quicksort():
    rng = random.Random(6)
    text = bytes(rng.choice(b"abc") for _ in range(3000)) + b"abcabcab" * 60
    starts = np.array([rng.randrange(len(text) - 32) for _ in range(2000)])
    group = np.array([rng.randrange(5) for _ in range(2000)])
    for depth in (8, 32):
        order, begin = S.multikey_quicksort(text, starts, group, depth)
        cut = [(int(group[k]), text[starts[k] : starts[k] + depth]) for k in order]
        assert sorted(order.tolist()) == list(range(2000)) and cut == sorted(cut)
        assert begin.tolist() == [k for k in range(2000) if k == 0 or cut[k] != cut[k - 1]]
    assert not len(S.multikey_quicksort(b"", starts[:0], group[:0], 8)[1])


def test_blind_trie():
    rng = random.Random(4)
    strings = [bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(300)]
    own, order = S.blind_trie(strings)
    leaves = {}
    for s, c in zip(strings, own, strict=True):
        assert leaves.setdefault(c, s) == s
    assert [leaves[c] for c in order] == sorted(set(strings))


def test_awkward_rows(spark):
    out = S.remove_repeats(cases.frame(spark)).collect()
    assert len(out) == len(cases.rows())
    rows = [r[:2] for r in cases.rows() if r[0] is not None]
    null = next(r[1] for r in cases.rows() if r[0] is None and r[1])
    # the row without an id comes before all others
    compare([(-1, null), *dict(rows).items()], [*out, next(r for r in out if r.doc_id is None and r.n_bytes)] and [type("R", (), {**r.asDict(), "doc_id": -1 if r.doc_id is None and r.n_bytes else r.doc_id}) for r in out])
    assert S.remove_repeats(cases.empty(spark)).count() == 0


def test_long_text_in_pieces(spark):
    rng = random.Random(9)
    block = "".join(chr(97 + rng.randrange(26)) for _ in range(5000))
    text = block + "".join(chr(97 + rng.randrange(26)) for _ in range(1_200_000)) + block
    out = S.remove_repeats(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert (out.n_bytes, out.n_removed, len(out.spans)) == (len(text), 5000, 1)
