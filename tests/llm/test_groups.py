"""Mixing, near-duplicates, pseudonyms, toxicity and the pipeline, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from datetime import date, timedelta

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from terracell.llm import components, decontaminate, mixing, pseudonyms, quality, simhash, toxicity

from .conftest import SF, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= most * sizes[s]}
        if not over:
            target.update({s: left * weight[s] / total for s in open_})
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def check_mix(df):
    got = mixing.mix_report(df).collect()
    rows = df.select("doc_id", "text", "source").collect()
    size = [(r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in rows]
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter(size)
    sizes = Counter()
    for _, s, n in size:
        sizes[s] += n
    target = plain_targets(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source], abs=1e-6)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    return got, taken, target


def test_mix_meets_targets(spark, corpus):
    rng = random.Random(1)
    rows = [(d, t, s) for d, t, s in corpus] + [(1000 + i, words(rng, rng.randint(0, 300)), rng.choice(["s1", "s2", "é", "Z", None])) for i in range(500)]
    rows += [(5000, "", "empty"), (5001, None, "none")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got, taken, target = check_mix(df.repartition(5))
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(3, 0.03 * t), (s, taken[s], t)
    again = mixing.mix_report(df.repartition(2).orderBy("text")).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mix_of_odd_rows(odd, nothing):
    check_mix(odd.select("doc_id", "text", "source"))
    out = mixing.mixed(odd)
    assert out.columns == odd.columns and out.count() >= 0
    assert mixing.mix_report(nothing).count() == 0 and mixing.mixed(nothing).count() == 0


def test_rows_without_id_are_split(spark):
    """A source most of whose rows have no id still meets its target; equal rows are taken alike."""
    df = spark.range(2000).selectExpr("if(id % 4 = 0, id, null) AS doc_id", "concat(repeat('w ', 1 + int(id % 7)), int(id / 2)) AS text", "if(id % 3 = 0, 'b', 'a') AS source")
    got, taken, target = check_mix(df)
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(14, 0.01 * t), (s, taken[s], t)
    out = mixing.mixed(df)
    assert out.columns == df.columns and out.filter("doc_id IS NULL").count() > 1000


def test_hot_source_is_mixed_by_seeded_hash(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', 1 + int(id % 97)) AS text", "if(id % 3 = 0, 'b', 'a') AS source")
    one, two = (Counter({r.doc_id: r.taken for r in mixing.mix_report(df, seed=s).collect()}) for s in (1, 2))
    assert one != two
    assert sum(one.values()) == pytest.approx(sum(two.values()), rel=0.001)


def plain_flow(sizes, members, quotas, epochs):
    """Least cost of a largest flow, by shortest paths one token at a time."""
    n, m = len(sizes), len(quotas)
    flow = np.zeros((n, m), int)
    used, got, cost = [0] * n, [0] * m, 0
    while True:
        best = {}
        for p in range(n):
            if used[p] < epochs * sizes[p]:
                best["p", p] = (used[p] // sizes[p], [p])
        for _ in range(2 * (n + m)):
            for p in range(n):
                if ("p", p) in best:
                    for s in members[p]:
                        c, path = best["p", p]
                        if ("s", s) not in best or c < best["s", s][0]:
                            best["s", s] = (c, [*path, s])
            for s in range(m):
                if ("s", s) in best:
                    for p in range(n):
                        c, path = best["s", s]
                        if flow[p, s] and (("p", p) not in best or c < best["p", p][0]):
                            best["p", p] = (c, [*path, p])
        ends = [best["s", s] for s in range(m) if ("s", s) in best and got[s] < quotas[s]]
        if not ends:
            return sum(used), cost
        c, path = min(ends)
        cost += c
        used[path[0]] += 1
        got[path[-1]] += 1
        for i in range(0, len(path) - 1, 2):
            flow[path[i], path[i + 1]] += 1
            if i:
                flow[path[i], path[i - 1]] -= 1


def test_flow_is_largest_and_cheapest():
    rng = random.Random(3)
    for _ in range(60):
        n, m = rng.randint(1, 5), rng.randint(1, 4)
        sizes = [rng.randint(1, 6) for _ in range(n)]
        members = [rng.sample(range(m), rng.randint(1, m)) for _ in range(n)]
        quotas = [rng.randint(0, 12) for _ in range(m)]
        taken = mixing.Flow(sizes, members, quotas).solve(2)
        cost = sum(max(0, t - s) for t, s in zip(taken, sizes))
        assert (sum(taken), cost) == plain_flow(sizes, members, quotas, 2)
        assert all(t <= 2 * s for t, s in zip(taken, sizes))


def test_closest_sum():
    rng = random.Random(2)
    for _ in range(100):
        units, goal = [rng.randint(1, 40) for _ in range(rng.randint(0, 9))], rng.randint(0, 150)
        sums = {sum(u for i, u in enumerate(units) if m >> i & 1) for m in range(1 << len(units))}
        chosen = mixing.closest(units, goal)
        assert sum(u for u, c in zip(units, chosen) if c) == max(x for x in sums if x <= goal)
    chosen = mixing.closest([10**9 + 7, 3 * 10**8, 10**7], 13 * 10**8 + 100)
    assert chosen == [True, False, True] or sum(chosen) == 2


def test_overlapping_sources_share_documents(spark):
    """Documents of both sources go where they are missing, before any document is repeated."""
    rows = [(i, "w " * 10, ["a"]) for i in range(100)] + [(100 + i, "w " * 10, ["a", "b"]) for i in range(100)] + [(300, "w", []), (301, "w", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    decisions, targets = mixing.mix(df, weights=(1, 1), share=0.6)
    t = {r.source: r.target for r in targets.collect()}
    rows = decisions.collect()
    assert {tuple(r.pattern) for r in rows} == {("a",), ("a", "b"), (None,)}
    taken = sum(r["size"] * r.passes for r in rows)
    assert taken == pytest.approx(sum(t.values()), abs=21)
    assert max(r.passes for r in rows if "b" in r.pattern or "a" in r.pattern) == 1


def test_networks_in_parts(spark, monkeypatch):
    """Networks too large for the driver are solved part by part, to the same amount and cost."""
    rng = random.Random(7)
    rows = []
    for i in range(60):
        group = rng.randrange(4)
        members = sorted({f"g{group}s{rng.randrange(3)}" for _ in range(rng.randint(1, 3))})
        rows.append((members, rng.randint(1, 50)))
    rows = list({tuple(m): (m, n) for m, n in rows}.values()) + [([None], 9), ([None, "g0s0"], 7)]
    sources = sorted({s for m, _ in rows for s in m}, key=str)
    patterns = spark.createDataFrame(rows, "pattern array<string>, size long")
    targets = spark.createDataFrame([(s, float(rng.randint(0, 90))) for s in sources], "source string, target double")
    one = {tuple(r.pattern): r.taken for r in mixing._shares(patterns, targets, 2).collect()}
    monkeypatch.setattr(mixing, "ARCS", 3)
    two = {tuple(r.pattern): r.taken for r in mixing._shares(patterns, targets, 2).collect()}
    size = {tuple(m): n for m, n in rows}
    cost = lambda t: (sum(t.values()), sum(max(0, v - size[k]) for k, v in t.items()))
    assert set(one) == set(two) == set(size) and cost(one) == cost(two)


def fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    fps = [fingerprint(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                up[max(top(i), top(j))] = min(top(i), top(j))
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(top(i), []).append(d)
    return fps, [min((d for d in ids[top(i)] if d is not None), default=None) for i in range(len(rows))], [top(i) for i in range(len(rows))]


def near_copies(rng, n):
    base, rows = words(rng, 150).split(), []
    for d in range(n):
        w = list(base)
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            w[rng.randrange(len(w))] = words(rng, 1)
        rows.append((d, " ".join(w)))
    return rows


def check_groups(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    fps, ids, group = plain_components(rows)
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert got == Counter((d, f"{f:016x}", i) for (d, _), f, i in zip(rows, fps, ids))
    return rows, ids, group


@pytest.mark.parametrize("tree", [512, 3])
def test_near_duplicates_against_all_pairs(spark, corpus, monkeypatch, tree):
    """With trees of three, crowded shards go through the words between fingerprints."""
    monkeypatch.setattr(simhash.link_fingerprints, "__defaults__", (simhash.RADIUS, tree))
    rng = random.Random(5)
    rows = near_copies(rng, 80) + [(1000 + d, t) for d, t, _ in corpus] + [(2000 + i, words(rng, i)) for i in range(5)]
    rng.shuffle(rows)
    check_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_near_duplicates_of_odd_rows(odd, nothing):
    rows, ids, group = check_groups(odd)
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    want = Counter()
    for g in set(group):
        own = [d for (d, _), x in zip(rows, group) if x == g]
        want[min((d for d in own if d is not None), default=None)] += 1
    assert Counter(r.doc_id for r in kept.collect()) == want
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


def test_forest_finds_all_pairs():
    rng = np.random.default_rng(1)
    for n, spread in ((1, 3), (400, 6), (3000, 64)):
        base = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
        word = np.unique(base[rng.integers(0, 4, n)] ^ (np.uint64(1) << rng.integers(0, spread, n, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, spread, n, dtype=np.uint64)))
        shard = np.sort(rng.integers(0, 3, len(word)))
        near = np.bitwise_count(word[:, None] ^ word) <= 2
        a, b = np.nonzero(np.tril(near & (shard[:, None] == shard), -1))
        found = [p for x, y in simhash.Forest(shard, word).pairs(2, step=100) for p in zip(x.tolist(), y.tolist())]
        assert sorted(found) == sorted(zip(a.tolist(), b.tolist()))


def test_bands_leave_no_link_out(spark):
    """Whatever the number of bands, fingerprints two bits apart share a shard."""
    rng = random.Random(6)
    pairs = []
    for i in range(40):
        x = rng.getrandbits(64)
        y = x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        pairs.append((i, *(v - (1 << 64) if v >> 63 else v for v in (x, y))))
    df = spark.createDataFrame(pairs, "i int, x long, y long")
    for n in (3, 4, 5, 8):
        both = df.select("i", simhash._bands(df.x, n, 2).alias("a"), simhash._bands(df.y, n, 2).alias("b"))
        assert both.selectExpr("min(size(array_intersect(a, b)))").first()[0] >= 1


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 150)] + [(-5, 200), (200, 300), (7, 7), (8, 3)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(3)
    got = {r.node: r.label for r in components.components(df).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 150)} | {-5: -5, 200: -5, 300: -5}
    assert got == want
    assert components.components(df.filter("a = 7 AND b = 7")).count() == 0


def plain_feistel(places, bases, tweak, key, rounds=10):
    state, cut = list(places), len(places) // 2
    for r in range(rounds):
        half = state[cut:] if r % 2 == 0 else state[:cut]
        told = ",".join(map(str, half))
        for i in range(len(state)):
            if (i < cut) == (r % 2 == 0):
                inner = hashlib.sha256("|".join([key, tweak, str(r), str(i), told]).encode()).hexdigest()
                state[i] = (state[i] + int(hashlib.sha256((inner + key).encode()).hexdigest()[:12], 16)) % bases[i]
    return state


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def mod97(iban):
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def pseudonym(spark, *texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r for r in sorted(pseudonyms.pseudonymize(df, key).collect(), key=lambda r: r.doc_id)]


def test_pseudonyms_follow_the_plain_permutation(spark):
    card = "4539148803436467"
    fresh = "".join(map(str, plain_feistel([int(c) for c in card[:-1]], [10] * 15, "card", "k")))
    fresh += next(c for c in "0123456789" if luhn(fresh + c))
    ip = ".".join(map(str, plain_feistel([144, 137, 247, 239], [256] * 4, "ip", "k")))
    a, b = plain_feistel(divmod(date(2024, 2, 29).toordinal() - date(2000, 1, 1).toordinal(), 487), [75, 487], "date20", "k")
    day = date(2000, 1, 1) + timedelta(a * 487 + b)
    phone = "".join(map(str, plain_feistel([0, 1, 7, 5, 5, 5, 7, 7, 1, 3], [10] * 10, "phone", "k")))
    text = "pay {c} at {i} on {d}, call +1 ({p}) {q}-{r}."
    got = pseudonym(spark, text.format(c=card, i="144.137.247.239", d="2024-02-29", p="017", q="555", r="7713"))[0]
    assert got.text == text.format(c=fresh, i=ip, d=day, p=phone[:3], q=phone[3:6], r=phone[6:])
    assert (got.n_found, got.n_card, got.n_ip, got.n_date, got.n_phone) == (4, 1, 1, 1, 1)


def test_equal_values_stay_linked_and_formats_hold(spark):
    one, two, three, other = pseudonym(
        spark,
        "4539 1488 0343 6467 GB82 WEST 1234 5698 7654 32 123-45-6789 an.55@mail4.example.com 29.02.2024 31/12/1999",
        "4539148803436467 GB82WEST12345698765432 123-45-6789 an.55@mail4.example.com 29.02.2024 31/12/1999",
        "4539-1488-0343-6467",
        "4539148803436467",
    )
    plain = lambda t: re.sub("[ -]", "", t)
    assert plain(one.text) == plain(two.text) and one.n_found == two.n_found == 6
    assert plain(three.text) == other.text and re.fullmatch(r"\d{4}(-\d{4}){3}", three.text)
    card, iban, ssn, mail, day, last = two.text.split(" ")
    assert luhn(card) and card != "4539148803436467" and mod97(iban) == 1 and iban[:2] == "GB"
    assert re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", ssn)
    assert re.fullmatch(r"[a-z]{2}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com", mail)
    for text, century in ((day, 20), (last, 19)):
        d, m, y = map(int, re.split("[./]", text))
        assert date(y, m, d).year // 100 == century
    assert pseudonym(spark, "4539148803436467", key="other")[0].text not in ("4539148803436467", card)


def test_feistel_is_a_permutation(spark):
    df = spark.range(36524).selectExpr("array(id div 397, id % 397) AS p", "array(92L, 397L) AS b")
    moved = df.select(pseudonyms.feistel(df.p, df.b, pseudonyms.F.lit("t"), "k").alias("m"))
    assert moved.filter("m[0] >= 0 AND m[0] < 92 AND m[1] >= 0 AND m[1] < 397").distinct().count() == 36524


def test_what_does_not_validate_stays(spark):
    texts = [
        "4539148803436468", "GB83WEST12345698765432", "2023-02-29", "31.04.2001", "00/13/2000", "666-12-1234", "1.2.3.4.5", "256.1.1.1 v", "12345",
        "plain words, nothing 12 to find", "1.800 2.500", "a@b", "", "token = 'short'", "3021-05-05", "555-1234",
    ]
    got = pseudonym(spark, *texts)
    assert [r.text for r in got] == texts and all(r.n_found == 0 for r in got)
    secret = pseudonym(spark, 'token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" x')[0]
    assert secret.n_secret == 1 and re.fullmatch(r'token = "[0-9a-f]{40}" x', secret.text) and "f3ef4d" not in secret.text


def test_account_numbers_end_where_their_country_says(spark):
    """A neighbour in capitals is no part of a number; each is found with or without blanks."""
    accounts = ["BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "GB82 WEST 1234 5698 7654 32", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947"]
    rows = [(k, f"IBAN {a} BIC {a.replace(' ', '')} AB") for k, a in enumerate(accounts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in pseudonyms.pseudonymize(df, "k").collect():
        a = accounts[r.doc_id]
        assert r.n_iban == 2 and a not in r.text and a.replace(" ", "") not in r.text
        size = len(a)
        apart, together = r.text[5 : 5 + size], r.text[5 + size + 5 : -3]
        assert r.text.startswith("IBAN " + a[:2]) and r.text[5 + size :].startswith(" BIC ") and r.text.endswith(" AB")
        assert apart.replace(" ", "") == together and mod97(together) == 1


def test_international_phone_numbers(spark):
    numbers = ["+44 20 7946 0958", "+33 1 23 45 67 89", "+49-30-901820", "+442079460958", "+353 (1) 679 3000", "+1 555 771 3000"]
    rows = [(k, f"call {n}, now") for k, n in enumerate(numbers)] + [(50, "a +12 b, 3+4444 and +1234567")]
    found = {r.doc_id: r for r in pseudonyms.pseudonymize(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    form = lambda t: "".join("0" if c.isdigit() else c for c in t)
    for k, n in enumerate(numbers):
        assert found[k].n_phone == 1 and n not in found[k].text and form(found[k].text) == form(rows[k][1])
    assert all(found[k].text[5:8] == code for k, code in ((0, "+44"), (1, "+33"), (2, "+49"), (3, "+44")))
    # Equal numbers stay equal, however grouped.
    digits = ["".join(c for c in found[k].text if c.isdigit()) for k in (0, 3)]
    assert digits[0] == digits[1]
    assert found[50].n_found == 0 and found[50].text == rows[-1][1]


def test_pseudonyms_of_odd_rows(odd, nothing):
    got = pseudonyms.pseudonymize(odd, "k")
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((r.doc_id, r.text) for r in odd.collect())
    assert pseudonyms.pseudonymize(nothing, "k").count() == 0


class PlainLearner:
    """FTRL-proximal with dicts, one row and one feature at a time; the bias has no L1."""

    def __init__(self, own):
        self.own, self.z, self.n = own, {}, {}

    def weight(self, f):
        z, l1 = self.z.get(f, 0.0), 0.0 if f == "bias" else self.own.l1
        if abs(z) <= l1:
            return 0.0
        return -(z - math.copysign(l1, z)) / ((self.own.beta + math.sqrt(self.n[f])) / self.own.alpha + self.own.l2)

    def learn(self, features, label):
        w = {f: self.weight(f) for f in (*features, "bias")}
        g = 1 / (1 + math.exp(-sum(w.values()))) - label
        for f, v in w.items():
            n = self.n.get(f, 0.0)
            self.z[f] = self.z.get(f, 0.0) + g - (math.sqrt(n + g * g) - math.sqrt(n)) / self.own.alpha * v
            self.n[f] = n + g * g


def test_training_against_plain_ftrl(spark):
    """Two rounds over one shard give the weights of the plain learner."""
    own = toxicity.Settings(bits=12, l1=0.7, l2=0.1, shards=1, rounds=2)
    rng = random.Random(9)
    rows = [(i, words(rng, rng.randint(0, 25)) + " bad!" * (i % 3 == 0), int(i % 3 == 0)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, text string, label int")
    at, weights, bias = toxicity.train(df, own)
    plain, features = PlainLearner(own), toxicity.Features(own.bits)
    order = df.selectExpr("xxhash64(id, text) AS place", "text", "label").orderBy("place", "label").collect()
    for _ in range(own.rounds):
        for r in order:
            plain.learn(features([r.text.encode()])[1].tolist(), r.label)
    want = {f: w for f in plain.z if f != "bias" for w in [plain.weight(f)] if w}
    assert dict(zip(at.tolist(), weights.tolist())) == {f: pytest.approx(w) for f, w in want.items()} and want
    assert bias == pytest.approx(plain.weight("bias"))


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(4)
    bad = [words(rng, 1) + "zz" for _ in range(8)]
    rows, labels = [], []
    for d in range(1500):
        w, toxic = words(rng, rng.randint(20, 80)).split(), d % 5 == 0
        for _ in range(rng.randint(2, 5) * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(bad).upper() + rng.choice(["", ",", "!!"]))
        rows.append((d, " ".join(w)))
        labels.append((d, int(toxic) if d % 3 else None, 9))
        labels += [(d, int(toxic), 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    got = toxicity.toxicity(docs, labels)
    rows = got.collect()
    assert len(rows) == 1500 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    right = Counter((r.doc_id % 5 == 0, r.predicted) for r in rows if r.held_out)
    assert right[True, 1] >= 0.9 * (right[True, 1] + right[True, 0]) and right[False, 1] <= 2
    assert Counter(map(tuple, rows)) == Counter(map(tuple, toxicity.toxicity(docs.repartition(5), labels).collect()))


def test_held_out_labels_teach_nothing(spark):
    rows = [(d, f"word{d % 7} again word{d % 11}") for d in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    own = toxicity.Settings(rounds=1, most=100)
    kinds = "doc_id long, toxic int"
    held = {d for d, _ in rows if zlib.crc32(str(d).encode()) % 3 == 1}
    one, two = (spark.createDataFrame([(d, (d % 2) ^ (flip and d in held)) for d, _ in rows], kinds) for flip in (False, True))
    assert sorted(map(tuple, toxicity.toxicity(docs, one, own).collect())) == sorted(map(tuple, toxicity.toxicity(docs, two, own).collect()))


def test_toxicity_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (7, None), (99, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity(odd, labels).count() == odd.count()
    none = toxicity.toxicity(odd, labels.filter("doc_id = 12345"))
    assert {r.score for r in none.collect()} == {0.5}
    assert toxicity.toxicity(nothing, labels).count() == 0


def test_pipeline_stage_by_stage(spark):
    """Each stage on what the one before kept, its decisions against those worked out plainly."""
    docs = corpus_pipeline.documents(spark, SF)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stage = dict(corpus_pipeline.STAGES)
    rows = lambda df: sorted((r.doc_id, r.text, r.source) for r in df.collect())

    kept = stage[names[0]](spark, docs, SF)
    assert kept.columns == docs.columns
    good = {r.doc_id for r in quality.quality_report(docs).filter("kept").collect()}
    assert rows(kept) == rows(docs.filter(docs.doc_id.isin(list(good))))

    one = stage[names[1]](spark, kept, SF)
    _, ids, _ = plain_components([(d, t) for d, t, _ in rows(kept)])
    assert one.columns == docs.columns and [r[0] for r in rows(one)] == sorted(set(ids))

    clean = stage[names[2]](spark, one, SF)
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert clean.columns == docs.columns
    assert {r[0] for r in rows(one)} - {r[0] for r in rows(clean)} >= {d for d, t, _ in rows(one) if any(i in decontaminate.normal(t) for i in items)}

    mix = stage[names[3]](spark, clean, SF)
    passes = {r.doc_id: r.taken // r["size"] for r in mixing.mix_report(clean).collect()}
    assert mix.columns == docs.columns and Counter(r[0] for r in rows(mix)) == Counter({d: n for d, n in passes.items() if n})

    last = stage[names[4]](spark, mix, SF).collect()
    assert Counter(r.doc_id for r in last) == Counter(r[0] for r in rows(mix))
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, last))
