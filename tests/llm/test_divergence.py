"""The source audit against sums and ranks made cell by cell in whole Python numbers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

DOCS = "doc_id long, text string, lang string, source string"


def brute(rows, min_docs=10, k=10):
    """Set of (lang, source, part, item, value, rank) of rows (text, lang, source)."""
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = sorted((t for t, n in docs[lang].items() if n >= min_docs), key=str.encode)
        all_ = {t: sum(count[lang, s][t] for s in sources) for t in kept}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[x] for x in kept) + 2 * len(kept)) for t in kept}
        q, p = share(all_), {s: share({t: count[lang, s][t] for t in kept}) for s in sources}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources - {s}]
            terms = [(f(p[s][t], q[t]), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, k)):
                for i, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.add((lang, s, part, item, v, i))
    return out


def found(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = [f"{rng.choice(['a', 'Éa', '中', 'zz', 'B'])}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    out = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "de", None, "x"]), f"s{min(rng.randrange(12), 4)}"
        at = hash(source) % 40 if lang == "en" else 0
        text = " ".join(rng.choices(words, [1 / (1 + abs(j - at)) for j in range(120)], k=rng.randrange(30))) + rng.choice(["", " ab1ab_Ab", "!"])
        out.append((i, text, "lone" if i < 15 else lang, "one" if i < 15 else source))
    return out


@pytest.mark.parametrize("seed, cells", [(1, 1 << 20), (2, 60)])
def test_equals_brute_force(spark, seed, cells):
    from kestrel.llm.divergence import audit

    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 1, "x", 0) for r in rows], DOCS + ", n int, term string, place int").repartition(6)
    assert found(audit(df, cells=cells)) == brute([r[1:] for r in rows])


def test_odd_cases(spark, odd, none):
    from kestrel.llm.divergence import audit

    assert audit(none).count() == 0
    rows = [tuple(r) for r in odd.select("text", "lang", "source").collect()]
    for least in (1, 2, 10):
        assert found(audit(odd, min_docs=least)) == brute(rows, least)
    assert {r[2:5:2] for r in found(audit(odd))} == {("pair", 0)}  # no term has ten documents


def test_tasks_that_send_in_between_change_nothing(spark, monkeypatch):
    from kestrel.llm import divergence as D

    rows = corpus(5)
    df = spark.createDataFrame(rows, DOCS).coalesce(1)
    monkeypatch.setattr(D, "slices", lambda batch, column: [batch.slice(i, 7) for i in range(0, batch.num_rows, 7)])
    batches = [b for b in df.select("text", "lang", "source").na.fill("").toArrow().to_batches()]
    want = Counter()
    for text, lang, source in [r[1:] for r in rows]:
        want.update(((lang or ""), source or "", t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
    for held in (1 << 20, 50, 1):
        monkeypatch.setattr(D, "HELD", held)
        got = Counter()
        groups = []
        for b in D._group_counts(iter(batches)):
            for r in b.to_pylist():
                if r["term"]:
                    got[r["lang"], r["source"], r["term"]] += r["n"]
                else:
                    groups.append((r["lang"], r["source"]))
        assert got == want and len(groups) == len(set(groups)) and set(groups) == {(r[2] or "", r[3] or "") for r in rows}


def test_skyband_and_its_merging():
    from kestrel.llm.divergence import skyband

    rng = np.random.default_rng(4)
    for _ in range(30):
        m, k = int(rng.integers(1, 400)), int(rng.integers(1, 6))
        n, low, rank = rng.integers(0, 12, m), rng.integers(0, 12, m), rng.permutation(m)
        above = ((n[None] >= n[:, None]) & (low[None] <= low[:, None]) & (rank[None] < rank[:, None])).sum(1)
        assert sorted(skyband(n, low, rank, k, block=16).tolist()) == np.flatnonzero(above < k).tolist()
        part = rng.integers(0, 3, m)
        some = np.concatenate([np.flatnonzero(part == i)[skyband(n[part == i], low[part == i], rank[part == i], k)] for i in range(3)])
        assert sorted(some[skyband(n[some], low[some], rank[some], k)].tolist()) == np.flatnonzero(above < k).tolist()


def test_whole_numbers_do_not_overflow():
    from kestrel.llm.divergence import SCALE, share

    for n, size in ((0, 2), (10**13, 10**13 + 2), (8 * 10**14, 10**15), (5, 9 * 10**15 - 1)):
        assert share(np.array([n]), np.array([size])).tolist() == [1 + SCALE * (n + 2) // size]


def test_bands_of_many_groups_are_sent_on(spark, monkeypatch):
    from kestrel.llm import divergence as D

    rows = corpus(7)
    df = spark.createDataFrame(rows, DOCS)
    kept = D.kept_counts(df)
    table = kept.where("term != '' and n > 0").select("lang", "source", "term", "n", "lang_n").toArrow()
    batches = table.to_batches(max_chunksize=20)
    merged = next(D._bands(10)(iter(b for t in [D.pa.Table.from_batches(list(D._bands(10, 30)(iter(batches))))] for b in t.combine_chunks().to_batches())))
    whole = next(D._bands(10)(iter(table.combine_chunks().to_batches())))
    key = lambda b: sorted(map(str, b.to_pylist()))
    assert key(merged) == key(whole)
