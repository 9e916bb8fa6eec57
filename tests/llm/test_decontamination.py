"""op5: copies, re-parameterised questions, and what is neither."""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(__file__))

import corpus  # noqa: E402
from tributary.llm import decontaminate as dc  # noqa: E402

ITEM = "A train leaves Berlin at 9 with 120 people, and Anna counts 120 seats. After 3 hours Anna has walked 5 km."


def leaks(spark, texts, items=(ITEM,)):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in dc.find_leaks(docs, bench).collect()}


def test_reparameterised_question(spark):
    other = ITEM.replace("120", "88").replace("Anna", "Olga").replace("Berlin", "Paris").replace("5", "17")
    twisted = ITEM.replace("120 seats", "121 seats").replace("Anna has", "Maria has")
    pad = corpus.prose(3, 50)
    got = leaks(spark, [ITEM, f"{pad} {other} {pad}", twisted, pad, None, "", ITEM.upper(), f"{other} {ITEM}"])
    assert got[(0, 0)].exact and got[(0, 0)].coverage == 1.0
    assert (1, 0) in got and not got[(1, 0)].exact
    # a changed value costs the windows it is in, not those without it
    assert (2, 0) in got and 0.3 <= got[(2, 0)].coverage < 1
    plain = corpus.prose(12, 30)
    assert set(leaks(spark, [plain.upper()], [plain])) == {(0, 0)}  # words all in capitals aren't names
    assert (3, 0) not in got and (4, 0) not in got and (5, 0) not in got
    assert got[(7, 0)].exact  # each alignment is judged on its own


def test_equal_values_of_an_item_asked_as_different_ones(spark):
    texts = [ITEM.replace("120 people", "57 people").replace("120 seats", b).replace("Berlin", "Rome").replace("Anna", "Ida")
             for b in ("88 seats", "57 seats")]
    # the item's values in other places: no alignment of most windows keeps them one for one
    got = leaks(spark, [*texts, ITEM.replace("120 seats", "121 seats")])
    assert set(got) == {(0, 0), (1, 0), (2, 0)}
    assert got[(0, 0)].matched < got[(1, 0)].matched == got[(1, 0)].windows
    assert not got[(0, 0)].exact and got[(2, 0)].exact  # what is left of the third has the item's own values


def test_slot_rule_against_brute_force(spark):
    """Random items and documents of few words: matched windows by the book."""
    import random
    from collections import Counter

    rng = random.Random(9)
    word = lambda: rng.choice("the of train has km and seats for".split())
    item = lambda: " ".join(str(rng.randint(1, 3)) if rng.random() < 0.3 else word() for _ in range(14))
    items = [item() for _ in range(6)]
    texts = []
    for _ in range(40):
        t = rng.choice(items).split()
        texts.append(" ".join(["x"] * rng.randint(0, 2) + [str(rng.randint(1, 4)) if w.isdigit() and rng.random() < 0.6 else w for w in t]))

    def grams(t):
        toks = re.findall(r"\w+", t)
        kind = []
        for i, w in enumerate(toks):
            kind.append(1 if w.isdigit() else 2 if i and kind[i - 1] == 1 and w in dc.UNITS else 0)
        n = min(8, len(toks))
        return [(k, tuple(w if c == 0 else c for w, c in zip(toks[k:k + n], kind[k:k + n])),
                 [f"{c}:{w}" for w, c in zip(toks[k:k + n], kind[k:k + n]) if c])
                for k in range(len(toks) - n + 1) if sum(c == 0 for c in kind[k:k + n]) >= min(dc.LITERALS, -(-n // 2))]

    def matched(item, text):
        lines = {}
        for k, g, a in grams(item):
            for j, h, b in grams(text):
                if g == h:
                    lines.setdefault(j - k, set()).add((k, tuple(zip(a, b))))
        places = set()
        for met in lines.values():
            count, kept = Counter(p for _, ps in met for p in ps), []
            for p in sorted(count, key=lambda p: (-count[p], p[0] != p[1], p)):
                if not any((p[0] == q[0]) | (p[1] == q[1]) for q in kept):
                    kept.append(p)
            places |= {k for k, ps in met if all(p in kept for p in ps)}
        return len(places)

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.matched for r in dc.find_leaks(docs, bench, coverage=0.01).collect() if r.matched}
    want = {(d, i): m for d, t in enumerate(texts) for i, x in enumerate(items) if (m := matched(x, t))}
    assert got == want and len(want) > 20


def test_verbatim_runs_of_any_words(spark):
    pad, long = corpus.prose(3, 50), corpus.prose(40, 600)
    names = "Did Anna Meet Olga And Maria Near Paris Or Berlin With Peter"
    items = ["Compute 17 + 25 - 9", "3 5 8 13 21 34 55 89", names, long, f"{ITEM} {pad}"]
    part = " ".join(long.split()[200:280])
    texts = [f"{pad} compute 17 + 25 - 9 {pad}", "Now: 3 5 8 13 21 34 55 89.", names.lower(), names.upper(),
             f"x {part} y", f"{ITEM.replace('120 seats', '121 seats')} {pad}", "compute 17 + 26 - 9", "3 5 8 13 21 34 55 90",
             " ".join(long.split()[200:212])]
    got = set(leaks(spark, texts, items))
    assert got >= {(0, 0), (1, 1), (2, 2), (3, 2), (4, 3), (5, 4)}
    assert not {x for x in got if x[0] in (6, 7, 8)}


def test_whole_table_against_substrings(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = corpus.read(spark, "documents", sf), corpus.read(spark, "benchmark", sf)
    flat = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    items = {r.item_id: flat(r.text) for r in bench.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items.items() if t in flat(r.text)}
    got = {(r.doc_id, r.item_id): r for r in dc.find_leaks(docs, bench).collect()}
    assert want and set(got) == want and all(r.exact for r in got.values())


def windows(t):
    """Template windows by the book."""
    out = []
    words = [(m[0], m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", t)]
    kinds = []
    for i, (w, a, _) in enumerate(words):
        number = w[0].isdigit()
        unit = i and kinds[i - 1] == 1 and w.lower() in dc.UNITS
        inner = i and not re.search(r'[.!?:;"\n]', t[words[i - 1][2]:a])
        kinds.append(1 if number else 2 if unit else 3 if w[0].isupper() and w[1:2].islower() and inner else 0)
    for i in range(len(words) - 7):
        if sum(k == 0 for k in kinds[i:i + 8]) >= 4:
            out.append(tuple(w.lower() if k == 0 else k for (w, _, _), k in zip(words[i:i + 8], kinds[i:i + 8])))
    return out


def test_templates_by_the_book():
    import pyarrow as pa

    texts = [ITEM, ITEM.replace("Anna", "Élise"), corpus.prose(4, 60), "3 Km 4 Hours. Ägypten is 12,5 times as Large as one Ü 7 a b c d"]
    t = dc.Templates(pa.array(texts))
    h, at = t.windows(8)
    rows = t.words.row[at]
    seen = {}
    for r, text in enumerate(texts):
        want, got = windows(text), h[rows == r].tolist()
        assert len(want) == len(got)
        for w, x in zip(want, got):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_short_items_blocks_and_empty_tables(spark, monkeypatch):
    got = leaks(spark, ["we say hello big world today", "hello world"], ["Hello big world", "", None])
    assert set(got) == {(0, 0)}
    assert leaks(spark, [], [ITEM]) == {} and leaks(spark, [ITEM], []) == {} and leaks(spark, [ITEM], [None]) == {}
    monkeypatch.setattr(dc, "BLOCK_WINDOWS", 5)
    assert set(leaks(spark, [ITEM, corpus.prose(1, 90)])) == {(0, 0)}


def test_odd_documents(spark):
    docs = corpus.frame(spark)
    bench = spark.createDataFrame([(1, corpus.prose(2, 300), "x"), (1, corpus.prose(2, 300), "y"), (None, "one", "z")],
                                  "item_id long, text string, window string")
    got = sorted((r.doc_id or 0, r.item_id or 0) for r in dc.find_leaks(docs, bench).collect())
    assert got == [(5, 1), (6, 0), (6, 1), (7, 0)] or set(got) >= {(5, 1), (6, 1)}
    kept = dc.keep_unleaked(docs, bench.where("item_id = 1"))
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
