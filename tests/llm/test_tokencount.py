import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from placeloom.llm import tokencount as t

COUNTER = t.Counter(open(t.VOCABULARY, "rb").read())


def full(text):
    return len(COUNTER.encoding.encode_ordinary(text))


def splice(text, start, removed, inserted):
    start = min(max(start, 0), len(text))
    removed = min(max(removed, 0), len(text) - start)
    return text[:start] + inserted + text[start + removed :]


bits = st.text(alphabet=st.sampled_from(list("ab'sre  \n\t1!é")), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'st ll  \n\t12!?éß　")), max_size=300), st.lists(st.tuples(st.integers(-2, 320), st.integers(-1, 60), bits), max_size=8))
def test_edits_count_as_a_full_encoding(text, edits):
    run, t.RUN = t.RUN, 3
    try:
        tree = t.Tree.of(COUNTER, text)
        assert tree.n_tokens == full(text)
        for e in edits:
            text = splice(text, *e)
            tree.edit(*e)
            assert tree.text == text and tree.n_chars == len(text) and tree.n_tokens == full(text)
            assert [x for r in tree.runs for x in r[1]] == [len(p) for p in COUNTER.split(text)]
    finally:
        t.RUN = run


def test_an_edit_encodes_little():
    r = random.Random(1)
    text = " ".join("".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 9))) for _ in range(20_000))
    tree = t.Tree.of(COUNTER, text)
    for _ in range(200):
        e = (r.randrange(len(text)), r.randrange(30), "new words here"[: r.randrange(15)])
        text = splice(text, *e)
        assert tree.edit(*e) <= 16
    assert tree.n_tokens == full(text)


DOCS = [(None, None), (1, ""), (2, "short"), (3, "it's 1999, isn't it?\n\n  yes  " * 50), (3, "x"), (4, "word " * 40_000)]


def test_query_matches_a_full_encoding(spark):
    df = spark.createDataFrame([(*d, 0, "x") for d in DOCS], "doc_id long, text string, edits int, seq string")
    got = t.count(df, t.revision()).collect()
    want = []
    for doc_id, text in DOCS:
        text = text or ""
        n = len(text)
        after = splice(splice(splice(text, n // 4, 12, " revised passage"), n // 2, 0, "\n\n[note 7] "), 3 * n // 4, 20, "")
        want.append((doc_id, n, full(text), len(COUNTER.split(text)), 3, len(after), full(after)))
    assert sorted(((r.doc_id, r.n_chars, r.n_tokens, r.n_pretokens, r.n_edits, r.n_chars_after, r.n_tokens_after) for r in got), key=str) == sorted(want, key=str)
    assert all(r.n_reencoded < 120 for r in got)
    assert t.count(df.limit(0), t.revision()).count() == 0


def test_kept_trees(spark):
    docs = [d for d in DOCS if d[0] in (1, 2, 4)]
    trees = t.build(spark.createDataFrame(docs, "doc_id long, text string"))
    texts = dict(docs)
    r = random.Random(3)
    edits = [(r.choice([1, 2, 4, 9]), i, r.randrange(300), r.choice([None, 0, 9]), r.choice([None, "new", " a b"])) for i in range(60)]
    for d, _, a, b, c in edits:
        if d in texts:
            texts[d] = splice(texts[d], a, b or 0, c or "")
    random.Random(4).shuffle(edits)
    out = t.apply(trees, spark.createDataFrame([*edits, (2, None, None, 1, "x")], "doc_id long, seq long, start long, removed long, inserted string")).collect()
    assert {x.doc_id: x.n_tokens for x in out} == {d: full(text) for d, text in texts.items()}
    assert {x.doc_id: "".join(run.text for run in x.runs) for x in out} == texts


@pytest.mark.parametrize("text", ["a\x1cb \x85 c", "tab\tend ", "　　x"])
def test_white_space_is_the_vocabulary_s(text):
    assert t.Tree.of(COUNTER, text).n_tokens == full(text)
