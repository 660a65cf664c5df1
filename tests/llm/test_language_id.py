import math

import numpy as np

from tests.llm import cases
from tests.conftest import SMALL
from tilewright.llm import language_id as L
from tilewright.llm import queries


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 6, 9, 30):
        code = L.codewords(n)
        far = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert code.shape[0] == n and min(far) >= max(1, code.shape[1] // 4)


def test_long_texts_in_pieces_have_the_same_features(monkeypatch):
    text = "abc déf ghi jkl " * 70_000
    assert np.isclose(L.features(text), L.features(text[: 16 * 1000]), atol=2e-3).all()


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in queries.table(spark, SMALL, "documents").collect()}
    out = [r for r in queries.op10_ecoc_language_id(spark, SMALL).collect() if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in out]) > 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_decoding_against_plain_loss():
    """The codeword of least logistic loss, each bit weighted by its trust, computed bit by bit."""
    texts = {"en": "the cat sat on the mat and looked", "fr": "le chat est sur la table et regarde", "de": "die katze sitzt auf dem tisch", "es": "el gato se sienta en la mesa", "it": "il gatto siede sul tavolo",
             "nl": "de kat zit op de mat", "sv": "katten sitter mattan och tittar"}
    for languages in (list(texts)[:4], list(texts)):
        model = L.fit_texts([(" ".join(texts[lang].split()[k % 3 :]), lang) for lang in languages for k in range(6)])
        for text in (*texts.values(), "the chat sat sur dem table", "zz qq"):
            x, loss = L.features(text), {}
            for k, lang in enumerate(model.languages):
                loss[lang] = 0.0
                for bit in range(model.code.shape[1]):
                    margin = sum(float(x[f]) * float(model.weights[f, bit]) for f in np.flatnonzero(x)) + float(model.bias[bit])
                    loss[lang] += float(model.trust[bit]) * math.log1p(math.exp(-margin * float(model.code[k, bit])))
            best = min(loss, key=loss.get)
            share = {lang: math.exp(loss[best] - v) for lang, v in loss.items()}
            (tag,), (score,), (unsure,) = model.predict([text])
            second = sorted(share.values())[-2]
            assert tag == best and math.isclose(score, 1 / sum(share.values()), rel_tol=1e-4)
            assert abs(second - 0.8) < 1e-4 or unsure == (second > 0.8)


def test_samples_are_bounded(spark):
    rows = [(i, f"word{i} text", f"l{i % 7}") for i in range(700)] + [(None, "no key", "l1"), (701, None, "l1"), (702, "x", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    x, tongues = L.training_sample(df, "doc_id", "text", "lang", 20, 3)
    assert set(tongues) == {"l0", "l1", "l2"} and x.shape == (len(tongues), L.BUCKETS) and 30 <= len(tongues) <= 100
    assert L.training_sample(df.repartition(5), "doc_id", "text", "lang", 20, 3)[1] == tongues


def test_awkward_rows(spark):
    model = L.fit_texts([("the cat sat on the mat", "en"), ("le chat est sur la table", "fr")] * 5)
    out = L.identify(cases.frame(spark), model, ["doc_id", "score"])
    assert out.columns == ["doc_id", "score", "lang_pred", "score_", "ambiguous"] and out.count() == len(cases.rows())
    tags, scores, unsure = model.predict([None, "", "123 !", "the cat on the mat"])
    assert tags == ["und", "und", "und", "en"] and scores[:3] == [0, 0, 0] and unsure[0]
    assert L.fit_texts([]).predict(["abc"])[0] == ["und"] and L.fit_texts([("abc", "en")]).predict(["abc"])[0] == ["en"]
    assert L.training_sample(cases.empty(spark), "doc_id", "text", "lang")[1] == []
    assert L.identify(cases.empty(spark), model, ["doc_id"]).count() == 0
