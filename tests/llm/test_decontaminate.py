import hashlib
import random
import re

import pytest

from placeloom.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(docs, items, window=13):
    wins = []
    for item_id, text in items:
        if item_id is None or text is None:
            continue
        w = WORD.findall(lower(text))
        n = min(window, len(w))
        wins += [(str(item_id), w[i : i + n]) for i in range(len(w) - n + 1) if n]
    out = []
    for doc_id, text in docs:
        w = WORD.findall(lower(text))
        hit, found = set(), set()
        for item_id, win in wins:
            for i in range(len(w) - len(win) + 1):
                if w[i : i + len(win)] == win:
                    hit |= set(range(i, i + len(win)))
                    found.add(item_id)
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def case(seed=1):
    r = random.Random(seed)
    vocabulary = ["the", "of", "Ünd", "Éa", "x1", "and", "b-c", "ñ"] + [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(i, text(r.choice([3, 12, 13, 14, 40]))) for i in range(12)] + [(12, "the of"), (13, ""), (14, None), (None, text(15))]
    docs = [(None, text(5)), (1, None), (2, ""), (3, "?!"), (3, text(30))]
    for i in range(10, 40):
        parts = [text(r.randrange(60))]
        for _ in range(r.randrange(3)):
            _, t = r.choice([x for x in items if x[1]])
            w = t.split()
            a = r.randrange(len(w)) if r.random() < 0.3 else 0
            parts += [" ".join(w[a:]), text(r.randrange(50))]
        docs.append((i, r.choice([" ", ", ", "\n"]).join(parts).replace("the", r.choice(["the", "THE"]))))
    return docs, items


@pytest.mark.parametrize("block_bytes", [8 << 20, 400])
def test_matches_brute_force(spark, block_bytes):
    docs, items = case()
    docs_df = spark.createDataFrame([(a, b, "x", 1) for a, b in docs], "doc_id long, text string, n_words string, items int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = d.report(docs_df, bench, block_bytes=block_bytes).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got), key=str) == brute(docs, items)
    kept = d.remove(docs_df, bench, block_bytes=block_bytes)
    assert kept.columns == docs_df.columns
    clean = [x[0] for x in brute(docs, items) if not x[-1]]
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, clean))


@pytest.mark.parametrize("block_bytes", [8 << 20, 400])
def test_remove_judges_each_row_alone(spark, block_bytes):
    docs, items = case()
    passage = next(t for i, t in items if t and len(t.split()) == 40)
    docs += [(None, passage), (None, "clean"), (3, passage), (3, "clean too"), (3, passage), (None, None)]
    df = spark.createDataFrame([(a, b, f"row {i}", i) for i, (a, b) in enumerate(docs)], "doc_id long, text string, n_words string, items int")
    kept = d.remove(df, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    want = [i for i, x in enumerate(docs) if not brute([x], items)[0][-1]]
    assert kept.schema == df.schema and sorted(r["items"] for r in kept.collect()) == want
    assert len(want) < len(docs) and {len(docs) - 5, len(docs) - 3, len(docs) - 1} <= set(want)


def test_longest_match(spark):
    w = [f"v{i}" for i in range(60)]
    bench = spark.createDataFrame([(7, " ".join(w))], "item_id long, text string")
    docs = spark.createDataFrame([(1, "q r " + " ".join(w[10:40]) + " z " + " ".join(w[:14])), (2, " ".join(w[:12]))], "doc_id long, text string")
    got = {r.doc_id: r for r in d.report(docs, bench).collect()}
    assert (got[1].longest_match, got[1].longest_item, got[1].longest_at, got[1].item_at, got[1].n_hit) == (30, "7", 2, 10, 44)
    assert got[2].n_hit == 0 and not got[2].contaminated


def brute_longest(docs, items, window=13):
    """(doc_id, longest_match, longest_item, longest_at, item_at) by comparing every place with every place."""
    cut = [(str(i), WORD.findall(lower(t))) for i, t in items if i is not None and t is not None]
    least = min(min(window, len(w)) for _, w in cut if w)
    out = []
    for doc_id, text in docs:
        w, best = WORD.findall(lower(text)), (0, 0, "", 0)
        for name, words in cut:
            before = [0] * (len(words) + 1)
            for i in range(len(w) - 1, -1, -1):
                row = [before[j + 1] + 1 if w[i] == words[j] else 0 for j in range(len(words))] + [0]
                best = min([best, *((-n, i, name, j) for j, n in enumerate(row) if n >= least)])
                before = row
        out.append((doc_id, -best[0], *(best[2], best[1], best[3])) if best[0] else (doc_id, 0, None, None, None))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [8 << 20, 400])
@pytest.mark.parametrize("seed", [1, 2])
def test_longest_match_of_every_document_in_a_slice(spark, seed, block_bytes):
    docs, items = case(seed)
    passage = next(t for i, t in items if t and len(t.split()) == 40)
    docs += [(100 + i, f"copy q{i} {passage} end") for i in range(5)] + [(110 + i, f"part {' '.join(passage.split()[i : 30 + i])} end") for i in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = d.report(df, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes).collect()
    assert sorted(((r.doc_id, r.longest_match, r.longest_item, r.longest_at, r.item_at) for r in got), key=str) == brute_longest(docs, items)
    assert all(r.longest_match >= 2 for r in got if r.n_hit) and sum(r.longest_match >= 40 for r in got) >= 5


def test_longest_match_has_no_limit(spark):
    words = [f"u{i}" for i in range(9000)]
    docs = [(i, f"a b {' '.join(words[i:])} c") for i in range(3)] + [(3, " ".join(words[:5000] + words[4000:]))]
    got = d.report(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")).collect()
    assert [(r.longest_match, r.longest_at, r.item_at) for r in sorted(got)] == [(9000, 2, 0), (8999, 2, 1), (8998, 2, 2), (5000, 0, 0)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert d.report(docs, bench).count() == 0
    assert d.report(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), bench).first().n_words == 2


def test_a_very_long_text(spark):
    words = [f"u{i % 5000}" for i in range(600_000)]
    docs = [(1, " ".join(words)), (2, "u1 u2")]
    got = {r.doc_id: r for r in d.report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(words[100:200])), (8, "u2 u1")], "item_id long, text string")).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].n_items, got[1].longest_match) == (600_000, 120 * 100, 1, 100) and got[2].n_hit == 0
