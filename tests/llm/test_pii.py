import random
import re

import pytest
from pyspark.sql import functions as F

from linepulse.llm import pii
from tests.llm.cases import docs, messy

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    double = [sum(divmod(2 * int(c), 10)) for c in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(double)) % 10 == 0


def plain(text):
    cards = [(m, re.sub("[ -]", "", m.group())) for m in CARD.finditer(text)]
    return [[m.span() for m in EMAIL.finditer(text)],
            [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
            [m.span() for m, d in cards if 13 <= len(d) <= 19 and luhn(d)],
            [m.span() for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]]


ODD = ["a@b", "a@b.c@d.e", "a@@b.c", "x@y.z.", "1.2.3.4.5.6.7.8", "999.1.1.1 1.1.1.1", "a.b@c-d.e-f @x.y",
       "4111 1111-1111 1111 4111111111111111x", "+1 (555) 123-4567 ++1 555 123 4567", "%@a.b..c",
       " 01.002.3.4", "000000000001.2.3.4", "+1 2.3.4.5.6.7.8.9", "é@b.co ü+49 30 1234567.", "١٢٣.1.2.3"]


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("01a@.+- (x%") for _ in range(40)) for _ in range(5000)]
    assert [t for t in texts if pii.base_spans(t) != plain(t)] == []


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000 + "@", "1." * 150_000,
                                  "a.b" * 90_000 + "@" * 500, "+1 (" * 60_000])
def test_long_runs_stay_linear(text):
    pii.spans_of(text)


def test_votes_round_trip():
    for code in range(len(pii.KINDS) * pii.PATTERNS):
        kind, vote = pii.votes_of(code)
        assert pii.pattern_of(kind, tuple(vote)) == code


def test_em_finds_the_reliable_labelers():
    rng = random.Random(7)
    counts, truth = {}, {}
    for _ in range(6000):
        real = rng.random() < .4
        sure = (.9, .85, .8, .75, .5)               # the last labeler is a coin
        vote = tuple((1 if (rng.random() < s) == real else -1) if rng.random() < .8 else 0 for s in sure)
        code = pii.pattern_of(2, vote)
        counts[code] = counts.get(code, 0) + 1
        truth.setdefault(code, []).append(real)
    model = pii.fit_spans(counts)
    gap = [abs(model.reliability[j, 1, 2] - model.reliability[j, 0, 2]) for j in range(5)]
    assert gap[0] > gap[3] > gap[4]
    right = sum(sum(t == (model.probability[c] > .5) for t in ts) for c, ts in truth.items())
    assert right / 6000 > .85
    assert not pii.fit_spans({}).probability.any()


def test_documents(spark):
    rows = messy() + [(700 + i, t, "en", "s", 1) for i, t in enumerate(ODD)]
    rows += [(800 + i, f"call or phone me: (212) 555-01{i:02d} or mail joe{i} [at] example [dot] com, "
                       f"card 4111111111111111, host 10.0.0.{i}", "en", "s", 1) for i in range(30)]
    df = docs(spark, rows).withColumn("found", F.lit("clash")).withColumn("n_ip", F.lit(1))
    got = pii.find_personal_data(df).collect()
    assert len(got) == len(rows)
    texts = {}
    for r in rows:
        texts.setdefault(r[0], []).append(r[1] or "")
    for r in got:
        want = [",".join(f"{k}:{a}:{b}" for k, spans in zip(pii.KINDS, plain(t)) for a, b in spans)
                for t in texts[r.doc_id]]
        assert r.base_spans in want
        spans = [s for s in r.spans.split(",") if s]
        assert set(filter(None, r.base_spans.split(","))) <= set(spans)
        keys = [(pii.KINDS.index(k), int(a)) for k, a, _ in (s.split(":") for s in spans)]
        assert keys == sorted(keys)
    assert pii.find_personal_data(docs(spark, [])).count() == 0


def test_candidates_do_not_overlap_base_spans():
    text = "reach joe@example.com, +1 (212) 555-0147, (212) 555-0147 and 4111111111111112"
    found = pii.spans_of(text)
    base = [(s, e) for _, s, e, _, b in found if b]
    loose = [(s, e) for _, s, e, _, b in found if not b]
    assert base and loose
    assert all(e <= s2 or e2 <= s for s, e in loose for s2, e2 in base)
