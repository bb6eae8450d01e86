import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from cases import frame, prose, rows, texts_of

from shelfmark.llm import pii
from shelfmark.llm.boosting import Boosted, Calibration

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

ODD = ["a@b a@b.c.d-e@f.g x@@y.z é@é.com a.b%c+d-e@h-i.j_k", "1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.004 1..2.3.4 256.1.1.1 0000001.2.3.4",
       "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 4111111111111111 4-4 7", "+1 (2) 345.678-9012 +12 +1..... +123456789 ++44 20 7946 0958 "
       "+1 23 4111111111111111", "token a@b.c", "1234567890" * 30, "@" * 50 + "a@b.co" + "+" * 40 + "+1 234 567 8901" + ".1" * 60]


def _luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def _base(text):
    def digits(s):
        return re.sub("[^0-9]", "", s)

    checks = {"email": (EMAIL, lambda s: True), "ip": (IP, lambda s: all(int(p) <= 255 for p in s.split("."))),
              "card": (CARD, lambda s: 12 <= len(digits(s)) <= 19 and _luhn(digits(s))), "phone": (PHONE, lambda s: 9 <= len(digits(s)) <= 15)}
    found = [(m.start(), n, f"{kind}:{m.start()}:{m.end()}", kind) for n, (kind, (pattern, check)) in enumerate(checks.items())
             for m in re.finditer(pattern, text) if check(m[0])]
    found.sort()
    return [sum(f[3] == kind for f in found) for kind in checks], ",".join(f[2] for f in found)


def test_patterns_of_odd_rows(spark):
    table = rows() + [(100 + k, text, *rows()[0][2:]) for k, text in enumerate(ODD)]
    got = pii.scan(frame(spark, table)).collect()
    want = []
    for doc_id, text in texts_of(table):
        counts, listed = _base(text)
        want.append((str(doc_id), *counts, hashlib.sha256(listed.encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:6]) for r in got) == sorted(want)
    for r in got:
        assert {*_base(dict(texts_of(table))[r["doc_id"]])[1].split(",")} <= {*r["spans"].split(",")} or r["doc_id"] in (14, None)


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def _added(model, texts):
    texts = [t.encode() for t in texts]
    found = pii.added_spans(texts, [pii.pattern_spans(t) for t in texts], model)
    return [[t[a:b].decode() for a, b, _ in spans] for t, spans in zip(texts, found)]


def _card(draw):
    digits = "".join(str(draw.randint(0, 9)) for _ in range(15))
    return next(digits + str(k) for k in range(10) if _luhn(digits + str(k)))


def _planted(draw):
    a, b, c = draw.randint(200, 989), draw.randint(200, 999), draw.randint(1000, 9999)
    ip = [str(draw.randint(1, 255)) for _ in range(4)]
    card, name = _card(draw), draw.choice(["mara.holm", "jo_weber", "t.okafor88"])
    return draw.choice([
        (f"call ({a}) {b}-{c}", f"({a}) {b}-{c}"), (f"phone {a}-{b}-{c}", f"{a}-{b}-{c}"), (f"tel. {a}.{b}.{c}", f"{a}.{b}.{c}"),
        (f"{name} [at] mail{draw.randint(1, 9)} [dot] example [dot] org", None), (f"{name}(at)example(dot)net", None),
        (".".join(ip).replace(".", "[.]"), None), (f"{card} {_card(draw)}", card), (f"+1 ({a}) {b}-{c} {'.'.join(ip)}", f"+1 ({a}) {b}-{c}"),
        (".".join(card[k:k + 4] for k in range(0, 16, 4)), None)])


def test_personal_data_that_no_pattern_matches_is_found(model):
    draw, planted = random.Random(4), []
    while len(planted) < 300:
        said, value = _planted(draw)
        planted.append((f"{prose(draw.randint(0, 999), 12)} {said} {prose(draw.randint(0, 999), 9)}", value or said))
    assert not any(value in [t.encode()[a:b].decode() for a, b, _ in pii.pattern_spans(t.encode())] for t, value in planted)
    got = _added(model, [t for t, _ in planted])
    assert np.mean([value in found for found, (_, value) in zip(got, planted)]) > 0.9


def test_clean_look_alikes_are_left_alone(model):
    draw, texts = random.Random(5), []
    for _ in range(100):
        n = draw.randint
        texts += [f"{prose(n(0, 999), 10)} {said} {prose(n(0, 999), 8)}" for said in (
            f"on {n(1900, 2099)}-{n(10, 12)}-{n(10, 28)} at", f"{n(1, 9)},{n(100, 999)},{n(100, 999)} people", f"version {n(1, 9)}.{n(0, 9)}.{n(0, 9)}.{n(0, 9)} of",
            f"at 12:{n(10, 59)}:{n(10, 59)} they", f"order {n(10 ** 9, 10 ** 10)} was", "we met at home. Then", f"pi is 3.{n(10 ** 9, 10 ** 10)}",
            f"ISBN 978-3-{n(10, 99)}-{n(100000, 999999)}-{n(0, 9)}", f"pages {n(100, 999)}-{n(1000, 9999)}", f"{n(256, 999)}.{n(256, 999)}.{n(0, 9)}.{n(0, 9)}")]
    texts = [t for t in texts if not pii.pattern_spans(t.encode())]
    assert np.mean([len(found) > 0 for found in _added(model, texts)]) < 0.02


def test_added_spans_stay_clear_of_matches(model):
    text = f"{prose(1, 5)} 4111 1111 1111 1111, +1 (503) 555-5526 4795522935961213 mara [at] holm [dot] org and x@y.org {prose(2, 5)}".encode()
    base = pii.pattern_spans(text)
    added, = pii.added_spans([text], [base], model)
    assert [text[a:b] for a, b, _ in added] == [b"+1 (503) 555-5526", b"4795522935961213", b"mara [at] holm [dot] org"]
    assert pii.redact(text, base + added).count(b"[") == 5


def test_texts_keep_their_length_in_candidates():
    for text in ODD + [r[1] or "" for r in rows()]:
        data = text.encode()
        assert all(0 <= a < b <= len(data) for a, b, _ in pii.candidates(data))
        assert len(pii.candidates(data)) <= 20 + 3 * len(data)


def test_selection_is_the_best():
    draw = random.Random(2)
    for _ in range(200):
        spans = sorted({(a, a + draw.randint(1, 6), 0) for a in (draw.randint(0, 12) for _ in range(7))})
        p = [draw.randint(1, 9) / 10 for _ in spans]
        best = max(sum(p[k] for k in some) for n in range(len(spans) + 1) for some in itertools.combinations(range(len(spans)), n)
                   if all(spans[a][1] <= spans[b][0] or spans[b][1] <= spans[a][0] for a, b in itertools.combinations(some, 2)))
        chosen = pii.select(spans, p)
        assert all(a[1] <= b[0] for a, b in itertools.pairwise(chosen))
        assert round(sum(p[spans.index(s)] for s in chosen), 6) == round(best, 6)


def test_trees_and_calibration():
    draw = np.random.default_rng(1)
    x = draw.integers(0, 32, (3_000, 6)).astype(np.uint8)
    y = ((x[:, 0] > 10) & (x[:, 3] < 20) ^ (x[:, 5] == 3)).astype(int)
    trees = Boosted.fit(x[:2_000], y[:2_000])
    assert ((trees.scores(x[2_000:]) > 0) == y[2_000:]).mean() > 0.97
    noisy = (draw.random(1_000) < x[2_000:, 0] / 31).astype(int)
    calibration = Calibration(x[2_000:, 0].astype(float), noisy)
    shares = calibration.probability(np.arange(32.0))
    assert (np.diff(shares) >= 0).all() and np.abs(shares - np.arange(32) / 31).mean() < 0.1
    assert trees.scores(x[:0]).shape == (0,) and Calibration(np.zeros(0), np.zeros(0)).probability(np.ones(2)).tolist() == [0, 0]


def test_nothing_to_learn_from(spark):
    docs = frame(spark, [r for r in rows() if r[0] in (2, 3, 4, 5)])
    assert pii.fit(docs) == {} and pii.fit(frame(spark, [])) == {}
    assert [r["spans"] for r in pii.scan(docs).collect()] == [""] * 4
    assert pii.without_personal_data(frame(spark, [])).count() == 0


def test_redaction_keeps_rows_and_columns(spark, model):
    table = rows() + [(200, "mail a@b.org now", *rows()[0][2:])]
    got = pii.without_personal_data(frame(spark, table), model)
    assert got.columns == frame(spark, table).columns and got.count() == len(table)
    assert got.where("doc_id = 200").first()["text"] == "mail [EMAIL] now"
