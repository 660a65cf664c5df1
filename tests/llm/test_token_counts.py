import random

from tests.llm import brute, cases
from tilewright.llm import token_counts as T
from tilewright.llm.queries import VOCABULARY

RANKED = ["▁", "a", "b", "ab", "▁a", "aba", "ba", "bb", "▁abab", "c"]


def test_trie_counts_against_brute_force(monkeypatch):
    v, rng = T.Vocabulary.ranked(RANKED), random.Random(1)
    words = {"".join(rng.choice("aabbcé☃") for _ in range(rng.randrange(0, 12))) for _ in range(300)}
    trie = T.Trie(v)
    want = {w: brute.fewest_pieces(T.MARK + w, v.scores, v.byte_score)[1] for w in words}
    assert {w: trie.count(w) for w in words} == want
    monkeypatch.setattr(T, "LONG", 4)
    assert {w: T.Trie(v).count(w) for w in words} == want
    long = "".join(rng.choice("aabbcé☃") for _ in range(3000))
    assert T.Trie(v).count(long) == brute.fewest_pieces(T.MARK + long, v.scores, v.byte_score)[1]


def test_each_shared_prefix_is_scored_once():
    v = T.Vocabulary.ranked(RANKED)
    scored = []
    forward = v.forward
    v.forward = lambda word, end, path: scored.append(word[:end]) or forward(word, end, path)
    trie = T.Trie(v)
    for word in ("abab", "zz", "abac", "aba", "abab", "abacus"):
        trie.count(word)
    assert len(scored) == len(set(scored)) == len(trie.kids) == len(trie.scored) - 1 == 10


def test_scores_of_a_model_are_its_own():
    v = T.Vocabulary({"▁": -1.0, "a": -2.0, "b": -2.0, "ab": -5.0}, -20.0)
    assert T.Trie(v).count("ab") == 3  # two pieces of -2 beat one of -5
    assert T.Trie(T.Vocabulary({"▁": -1.0, "a": -2.0, "b": -2.0, "ab": -3.5}, -20.0)).count("ab") == 2


def test_documents(spark):
    v = T.Vocabulary.from_sentencepiece(VOCABULARY)
    df = cases.frame(spark).selectExpr("doc_id", "text", "n_chars as n_tokens")
    out = {r.doc_id: (r.n_tokens_, r.n_pretokens) for r in T.count_tokens(df, VOCABULARY, ["doc_id", "n_tokens", "text"], most_nodes=50).collect() if r.doc_id is not None}
    for i, text, *_ in cases.rows():
        if i is not None and i < 36:
            words = (text or "").split()
            assert out[i] == (sum(brute.fewest_pieces(T.MARK + w, v.scores, v.byte_score)[1] for w in words), len(words))
    assert T.count_tokens(cases.empty(spark), VOCABULARY, ["doc_id"]).count() == 0
