"""Base spans against the contract's own patterns; the two fits."""
import random
import re

from starledger.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    text, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    tests = [(EMAIL, lambda m: True), (IP, lambda m: all(int(p) <= 255 for p in m.split("."))),
             (CARD, lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
             (PHONE, lambda m: 9 <= len(digits(m)) <= 15)]
    for k, (pattern, test) in enumerate(tests):
        out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if test(m.group())]
    return sorted(out)


TEXTS = [
    None, "", "no data", "a@b.com_x@y.org", "a@b", "x@@y.z a.b+c@d-e.f.g.", "héé ü@x.de é.é@é.com 😀 a@b.co 1.2.3.4",
    "1.2.3.4.5.6.7.8", "256.1.1.1 255.255.255.255 000255.1.1.0300 01.02.03.04", "4111 1111 1111 1111, 4111-1111-1111-1112",
    "+1 (243) 555-5526 +49 30 1234567 +1 +12 +123456789012345678", "4" * 4000 + " 4111111111111111",
    "call 555-123-4567 or (212) 555-0100 and joe (at) mail (dot) com", "a" * 30000, "1 " * 3000, "+1" + "-1" * 3000,
    "+1 555 123 4567+1 555 123 4567", "token 04dbebab91ab85687d33eeaaf9ac699e1188f962", "1-2 3-4 5-6 7-8 9-0 1-2 3",
    "ip 10.0.0.1:80 mail me@x.y\n@z.q", "joe[at]x[dot]org joe@x.org(at)y(dot)com",
]


def test_base_spans_match_brute_force(spark):
    rnd = random.Random(3)
    alphabet = ["1", "23", "4111", ".", "@", "a", "-", " ", "+", "(", ")", "é", "😀", "com", "255", "\n", "_"]
    texts = TEXTS + ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(80))) for _ in range(600)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, base string, n_ip int")
    got = {r.doc_id: r for r in pii.find_pii(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = brute(t)
        assert [(s.start, pii.KINDS.index(s.kind), s.end) for s in got[i].base] == want, t
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(w[1] == j for w in want) for j in range(4)]
        found = [(s.start, pii.KINDS.index(s.kind), s.end) for s in got[i].found]
        assert set(want) <= set(found) and found == sorted(found)


def test_empty_null_id_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert pii.find_pii(spark.createDataFrame([], schema)).count() == 0
    rows = pii.find_pii(spark.createDataFrame([(None, "a@b.com"), (1, "a@b.com"), (1, "a@b.com"), (2, None)], schema)).collect()
    assert sorted((r.doc_id is None, r.n_email) for r in rows) == [(False, 0), (False, 1), (False, 1), (True, 1)]


def test_em_finds_the_unreliable_labeler():
    """Labelers 0, 1, 3, 4 agree with the truth nine times in ten; labeler
    2 is a coin."""
    rnd = random.Random(1)
    counts, truth = {}, {}
    for _ in range(20000):
        y = rnd.random() < 0.4
        code = 0
        for j in range(5):
            right = rnd.random() < (0.5 if j == 2 else 0.9)
            code = code * 3 + (1 if y == right else -1) + 1
        counts[code] = counts.get(code, 0) + 1
        truth.setdefault(code, [0, 0])[y] += 1
    belief = pii.fit_reliabilities([(0, c, n) for c, n in counts.items()])
    hits = sum(t[belief[0, c] > 0.5] for c, t in truth.items())
    best = sum(max(t) for t in truth.values())
    assert hits >= 0.99 * best
    for code in truth:  # the coin alone hardly moves the belief
        votes = pii._votes_of(code)
        votes[2] = -votes[2]
        other = sum((v + 1) * 3 ** (4 - j) for j, v in enumerate(votes))
        assert abs(belief[0, code] - belief.get((0, other), belief[0, code])) < 0.15


def test_classifier_follows_soft_labels():
    weights = pii.fit_classifier([(0, 4, 0.95, 100), (0, 60, 0.05, 300), (2, 4, 0.1, 50)])
    z = lambda k, s: sum(weights[j] for j in pii._shape_vector(k, s))
    assert z(0, 4) > 0 > z(0, 60) and z(2, 4) < 0


def test_numbers_that_fail_the_checksum_are_not_cards(spark):
    def valid(k):
        body = f"4{k:014d}"
        return next(body + c for c in "0123456789" if luhn(body + c))
    good = [valid(k * 7919 + 13) for k in range(60)]
    bad = [g[:-1] + str((int(g[-1]) + 1 + i % 9) % 10) for i, g in enumerate(good)]
    bad = [b for b in bad if not luhn(b)]
    docs = spark.createDataFrame([(i, f"paid word {t} other words") for i, t in enumerate(good + bad)], "doc_id long, text string")
    got = {r.doc_id: (len(r.base), len(r.found)) for r in pii.find_pii(docs).collect()}
    assert all(got[i] == ((1, 1) if i < len(good) else (0, 0)) for i in got)


def test_loose_spans_that_the_labelers_support_are_added(spark):
    texts = [f"call me: +1 (212) 555-{i:04d} now" for i in range(40)] + [f"phone: (212) 555-{i:04d} now" for i in range(20)]
    texts += [f"mail joe{i}@mail.com today" for i in range(40)] + [f"contact joe{i} (at) mail (dot) com today" for i in range(10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.find_pii(docs).collect()
    assert sum(len(r.found) > len(r.base) for r in rows) == 30 and all(len(r.found) == 1 for r in rows)
