import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from skein.llm import suffix_tree

from .messy import lower, messy, messy_rows


def tokens_of(text):
    return [w for w in "".join(" " if c in "\t\n\r\x0b\x0c" else c for c in lower(text)).split(" ") if w] + ["\n"]


def is_held(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 10 == 0


def check_base(rows, docs):
    counts = Counter(w for key, text in docs if not is_held(key) for w in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    wanted = []
    for key, text in docs:
        found = tokens_of(text)
        wanted.append((str(key), is_held(key), len(found), sum(counts[w] > 0 for w in found), n,
                       sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in found)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows]
    for one, two in zip(sorted(got), sorted(wanted), strict=True):
        assert one[:5] == two[:5] and one[5] == pytest.approx(two[5], rel=1e-9)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(6)
    follow = {w: draw.choices([f"w{n}" for n in range(60)], k=4) for w in [f"w{n}" for n in range(60)]}
    docs = []
    for key in range(400):
        text = [draw.choice(list(follow))]
        for _ in range(60):
            text.append(draw.choice(follow[text[-1]]))
        docs.append((key, " ".join(text) + (f" only{key}" if key % 3 == 0 else "")))
    return docs


def test_scores(spark, corpus):
    rows = suffix_tree.score(spark.createDataFrame(corpus, "doc_id long, text string").repartition(4)).collect()
    check_base(rows, corpus)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.score > r.base_score for r in held]) > 0.95
    assert sum(r.score for r in held) > 0.75 * sum(r.base_score for r in held)


def test_few_listed_words_leave_the_base_score_as_it_is(spark, corpus, monkeypatch):
    monkeypatch.setattr(suffix_tree, "LISTED_SHARE", 1e-2)
    monkeypatch.setattr(suffix_tree, "CONTEXT_SHARE", 2e-2)
    monkeypatch.setattr(suffix_tree, "HELD_PAIRS", 8)
    rows = suffix_tree.score(spark.createDataFrame(corpus, "doc_id long, text string").repartition(4)).collect()
    check_base(rows, corpus)


def test_distributions_sum_to_one_and_counts_are_exact(spark, corpus):
    docs = suffix_tree.texts(spark.createDataFrame(corpus, "doc_id long, text string").repartition(3))
    table = suffix_tree.tokenise(docs.selectExpr("*", "false as held_out"))
    tree = suffix_tree.fit(table, suffix_tree.vocabulary(table))
    assert len(tree.levels) >= 1 and len(tree.levels[0].nodes)
    base = np.append(tree.log_p, tree.log_unseen(0))  # every word is listed here, one more stands for the unknown
    words = np.append(tree.words, np.uint64(12345))
    names = {suffix_tree.word_hash(w.encode()): w for w in {w for _, t in corpus for w in tokens_of(t)}}
    assert (10.0 ** base).sum() == pytest.approx(1, abs=1e-9)
    seen = Counter(pair for _, t in corpus for pair in zip(["\n", *tokens_of(t)], tokens_of(t)))
    context = Counter(w for _, t in corpus for w in ["\n", *tokens_of(t)[:-1]])
    for one in [w for w in tree.words if names[int(w)] in ("w1", "w7", "\n")]:
        before = [np.full(len(words), one, np.uint64)] + [np.zeros(len(words), np.uint64)] * (len(tree.levels) - 1)
        log_p = tree.score(base, before, words)
        assert (10.0 ** log_p).sum() == pytest.approx(1, abs=1e-6)
        if len(tree.walk(before)[0][0]):
            kinds = sum(1 for (a, _) in seen if a == names[int(one)])
            for at, word in enumerate(tree.words):
                n = seen[names[int(one)], names[int(word)]]
                if n:
                    wanted = (n - suffix_tree.DISCOUNT + suffix_tree.DISCOUNT * kinds * 10 ** base[at]) / context[names[int(one)]]
                    assert log_p[at] == pytest.approx(math.log10(wanted), abs=1e-9)


def by_hand(docs):
    """Scores where no context is common and every word is listed: one rare context of one word before each token."""
    learnt = [["\n", *tokens_of(t)] for key, t in docs if not is_held(key)]
    counts = Counter(w for text in learnt for w in text[1:])
    n, v = sum(counts.values()), len(counts)
    base = lambda w: (counts[w] + 0.1) / (n + 0.1 * (v + 1))
    follow = {}
    for text in learnt:
        for one, two in zip(text, text[1:]):
            follow.setdefault(one, Counter())[two] += 1
    d, nodes = suffix_tree.DISCOUNT, {}
    for context, after in follow.items():
        size, listed = sum(after.values()), {w: c for w, c in after.items() if c >= 2}
        p = {w: (c - d + d * len(listed) * base(w)) / size for w, c in listed.items()}
        without = {w: (max(c - 1 - d, 0) + d * len(listed) * base(w)) / max(size - 1, 1) for w, c in listed.items()}
        rest = (1 - sum(p.values())) / (1 - sum(map(base, listed)))
        gain = sum(c * math.log(without[w] / base(w)) for w, c in listed.items())
        gain += (size - sum(listed.values())) * math.log(rest) if size > sum(listed.values()) else 0
        if gain > suffix_tree.GAIN:
            nodes[context] = p, rest
    out = []
    for _, text in docs:
        text, total = ["\n", *tokens_of(text)], 0.0
        for one, two in zip(text, text[1:]):
            p, rest = nodes.get(one, ({}, 1.0))
            total += math.log10(p.get(two, base(two) * rest))
        out.append(total)
    return out, len(nodes)


@pytest.fixture
def only_rare(monkeypatch):
    monkeypatch.setattr(suffix_tree, "CONTEXT_SHARE", 1.0)
    monkeypatch.setattr(suffix_tree, "HELD_RARE", 500)
    monkeypatch.setattr(suffix_tree, "TOKEN_BYTES", 5_000)
    monkeypatch.setattr(suffix_tree, "GROUP_TOKENS", 3_000)


def test_rare_contexts_against_a_plain_version(spark, corpus, only_rare):
    rows = suffix_tree.score(spark.createDataFrame(corpus, "doc_id long, text string").repartition(4)).collect()
    check_base(rows, corpus)
    wanted, _ = by_hand(corpus)
    assert [r.score for r in sorted(rows)] == pytest.approx(wanted, rel=1e-9)


def test_the_tree_grows_with_the_corpus(spark, corpus, only_rare):
    """Three corpora of different words have three times the nodes, none of which falls below a share."""
    docs = [(key + 400 * at, " ".join(f"{w}x{at}" for w in text.split())) for at in range(3) for key, text in corpus]
    wanted, nodes = by_hand(docs)
    assert nodes > 2.5 * by_hand(corpus)[1]
    rows = suffix_tree.score(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert [r.score for r in sorted(rows)] == pytest.approx(wanted, rel=1e-9)


def test_what_rare_contexts_add_does_not_multiply_with_the_groups(spark, corpus, only_rare):
    docs = suffix_tree.texts(spark.createDataFrame(corpus, "doc_id long, text string").repartition(3))
    table = suffix_tree.tokenise(docs.selectExpr("*", "false as held_out"))
    tree = suffix_tree.fit(table, suffix_tree.vocabulary(table))
    names = {suffix_tree.word_hash(w.encode()): n for n, w in enumerate(sorted({w for _, t in corpus for w in tokens_of(t)}))}
    place = np.argsort(tree.words)
    context, symbol, doc = [], [], []
    for key, text in corpus:
        found = [suffix_tree.word_hash(w.encode()) for w in ["\n", *tokens_of(text)]]
        assert all(w in names for w in found)
        context += found[:-1]
        symbol += place[np.searchsorted(tree.words, np.array(found[1:], np.uint64))].tolist()
        doc += [key << 1] * (len(found) - 1)
    held = [(np.array(context, np.uint64), np.zeros(len(doc), np.int32), np.array(symbol, np.int32), np.array(doc, np.int64))]
    counts, sums = [], []
    for groups in (1, 20):
        rows = suffix_tree.rare_rows(held, groups)
        parts = [suffix_tree.rare_deltas(tree, suffix_tree.pa.Table.from_batches([rows.slice(at, 1)])) for at in range(rows.num_rows)]
        counts.append(sum(len(docs) for docs, _ in parts))
        sums.append(np.bincount(np.concatenate([d for d, _ in parts]) >> 1, np.concatenate([x for _, x in parts]), minlength=400))
    assert counts[0] == counts[1] > 400
    assert sums[0] == pytest.approx(sums[1])


def test_a_text_that_occurs_twice_gains_from_its_rare_contexts(spark, corpus):
    draw = random.Random(8)
    many = [(key, " ".join(f"q{draw.randrange(10_000)}" for _ in range(60))) for key in range(1000, 2000)]
    twice = " ".join(f"z{n}" for n in range(50))
    docs = [*many, (3, twice), (4, twice)]
    assert not is_held(3) and not is_held(4)
    got = {r.doc_id: r for r in suffix_tree.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[3].score > got[3].base_score + 40 and got[3].score == pytest.approx(got[4].score)


def whole_tree(docs, share):
    """Scores and nodes by length. A context below ``share`` of all tokens needs more gain the longer it is; if it is one word,
    it lists symbols seen twice, any other all. One is common only if all its parts are."""
    learnt = [["\n", *tokens_of(t)] for key, t in docs if not is_held(key)]
    counts = Counter(w for text in learnt for w in text[1:])
    total, v, d = sum(counts.values()), len(counts), suffix_tree.DISCOUNT
    after = {}
    for text in learnt:
        for at in range(1, len(text)):
            for size in range(1, min(3, at) + 1):
                after.setdefault(tuple(text[at - size:at]), Counter())[text[at]] += 1
    nodes, common = {}, {}

    def p(context, word):
        if not context:
            return (counts[word] + 0.1) / (total + 0.1 * (v + 1))
        listed, rest = nodes[context]
        return listed[word] if word in listed else p(context[1:], word) * rest

    for context in sorted(after, key=len):
        if context[1:] and context[1:] not in nodes:
            continue
        size = sum(after[context].values())
        if len(context) == 1:
            common[context] = counts[context[0]] >= share * total
        else:
            common[context] = common.get(context[:-1], False) and after[context[:-1]][context[-1]] >= share * total
        least = 2 if len(context) == 1 and not common[context] else 1
        seen = {w: (c, p(context[1:], w)) for w, c in after[context].items() if c >= least}
        listed = {w: (c - d + d * len(seen) * q) / size for w, (c, q) in seen.items()}
        gain = sum(c * math.log(max((max(c - 1 - d, 0) + d * (len(seen) - (c == 1)) * q) / max(size - 1, 1), 1e-300) / q)
                   for c, q in seen.values())
        rest = (1 - min(sum(listed.values()), 1 - 1e-9)) / (1 - min(sum(q for _, q in seen.values()), 1 - 1e-9))
        gain += (size - sum(c for c, _ in seen.values())) * math.log(rest)
        if gain > suffix_tree.GAIN * (1 if common[context] else len(context)):
            nodes[context] = listed, rest
    out = []
    for _, text in docs:
        text, score = ["\n", *tokens_of(text)], 0.0
        for at in range(1, len(text)):
            context = ()
            while len(context) < min(3, at) and tuple(text[at - len(context) - 1:at]) in nodes:
                context = tuple(text[at - len(context) - 1:at])
            score += math.log10(p(context, text[at]))
        out.append(score)
    return out, Counter(map(len, nodes))


@pytest.fixture(scope="module")
def long_memory():
    """Texts of which the next word depends on three words before it, with words of all frequencies."""
    draw = random.Random(11)
    follow, docs = {}, []
    for key in range(300):
        text = ["w0"] * 3
        for _ in range(50):
            choice = follow.setdefault(tuple(text[-3:]), [f"w{int(12 * draw.random() ** 2)}" for _ in range(2)])
            text.append(draw.choice(choice) if draw.random() < 0.95 else f"w{int(300 * draw.random() ** 2)}")
        docs.append((key, " ".join(text[3:])))
    return docs


@pytest.mark.parametrize("context_share, listed_share", [(1.0, 0.02), (2e-2, 1e-2), (4e-3, 2e-3)])
def test_no_context_or_symbol_is_lost_below_the_shares(spark, long_memory, monkeypatch, context_share, listed_share):
    for name, value in (("CONTEXT_SHARE", context_share), ("LISTED_SHARE", listed_share), ("HELD_RARE", 500),
                        ("TOKEN_BYTES", 5_000), ("GROUP_TOKENS", 3_000), ("HELD_PAIRS", 50)):
        monkeypatch.setattr(suffix_tree, name, value)
    wanted, nodes = whole_tree(long_memory, context_share)
    assert nodes[2] > 50 and nodes[3] > 50
    rows = suffix_tree.score(spark.createDataFrame(long_memory, "doc_id long, text string").repartition(4)).collect()
    check_base(rows, long_memory)
    assert [r.score for r in sorted(rows)] == pytest.approx(wanted, rel=1e-9)


def test_symbols_are_looked_up_in_parts(spark, corpus, monkeypatch):
    """No part holds all groups, answers go to disk once, and no answer is shuffled before that."""
    for name, value in (("LISTED_SHARE", 1e-2), ("CONTEXT_SHARE", 2e-2), ("TOKEN_BYTES", 5_000), ("GROUP_TOKENS", 3_000)):
        monkeypatch.setattr(suffix_tree, name, value)
    written, write = [], suffix_tree.write_cut

    def write_cut(df, *by):
        folder = write(df, *by)
        if "answer" in df.columns or "answers" in df.columns:
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            written.append((df.columns, plan.count("Aggregate"), spark.read.parquet(folder).select("slice", "bucket").collect()))
        return folder

    monkeypatch.setattr(suffix_tree, "write_cut", write_cut)
    check_base(suffix_tree.score(spark.createDataFrame(corpus, "doc_id long, text string").repartition(4)).collect(), corpus)
    groups = [{r.bucket for r in rows} for *_, rows in written]
    assert len(groups) > 1 and all(groups) and sum(map(len, groups)) == len(set.union(*groups))
    assert all(columns == ["slice", "bucket", "answer", "part"] and len(rows) == len(set(rows)) for columns, _, rows in written)
    assert not any(aggregates for _, aggregates, _ in written)


def test_messy_table(spark):
    rows = suffix_tree.score(messy(spark)).collect()
    check_base(rows, [(k, t) for k, t, *_ in messy_rows()])
    assert all(r.score <= 0 for r in rows)
    assert suffix_tree.score(messy(spark, 0)).collect() == []
    lonely = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert {(r.train_tokens, r.n_known) for r in suffix_tree.score(lonely).collect()} == {(0, 0)}


def test_states_are_found_once(spark, corpus, monkeypatch):
    """The one pass that finds states leaves what is looked up: requests do not read the tokens again, and no step sorts pairs in rows."""
    for name, value in (("LISTED_SHARE", 1e-2), ("CONTEXT_SHARE", 2e-2), ("TOKEN_BYTES", 5_000), ("GROUP_TOKENS", 3_000)):
        monkeypatch.setattr(suffix_tree, name, value)
    plans, write = [], suffix_tree.write_cut

    def write_cut(df, *by):
        plans.append((df.columns, df._jdf.queryExecution().optimizedPlan().toString()))
        return write(df, *by)

    monkeypatch.setattr(suffix_tree, "write_cut", write_cut)
    check_base(suffix_tree.score(spark.createDataFrame(corpus, "doc_id long, text string").repartition(4)).collect(), corpus)
    asked = [plan for columns, plan in plans if "answer" in columns]
    counted = [plan for columns, plan in plans if "log_suffix" in columns]
    assert len(asked) == 2 and not any("flat#" in plan.split("MapInArrow")[-1].split("Relation")[0] for plan in asked)
    assert counted and not any("Aggregate" in plan for plan in counted)
    assert sum("codes" in columns and "log_p" not in columns for columns, _ in plans) == 1


def test_words_and_hashes():
    texts = [f"A{c}b{c}{c}ÉC{c}" for c in map(chr, range(0x180))] + ["", " \n", "  x", "y\x0b", "z" * 100_000]
    found, sizes = suffix_tree.words(suffix_tree.pa.array(["cut off", *texts]).slice(1))
    wanted = [lower(t).encode().split() for t in texts]
    assert [w.encode() for w in found.to_pylist()] == [w for text in wanted for w in text]
    assert sizes.tolist() == [len(text) for text in wanted]
    assert suffix_tree.word_hashes(found).tolist() == [suffix_tree.word_hash(w) for text in wanted for w in text]


def test_values_are_told_apart_even_where_their_high_bits_are_equal():
    draw = np.random.default_rng(3)
    few = draw.integers(0, 1 << 63, 50).astype(np.uint64)
    close = np.array([1 << 62, (1 << 62) + 1, (1 << 62) + 2], np.uint64)  # told apart by bits that the order leaves out
    for values in (draw.choice(few, 1000), np.tile(close, 300), draw.integers(0, 9, 500), np.array([-1, 1 << 62, -1]),
                   draw.choice([-0.5, 0.0, -7.25], 99), np.zeros(0, np.uint64), np.zeros(0, np.int64)):
        place, distinct = suffix_tree.told_apart(values)
        assert (distinct[place] == values).all() and sorted(distinct) == sorted(set(values.tolist()))
        if values.dtype == float:
            assert (suffix_tree.floats(suffix_tree.shared(values)) == values).all()


def test_find_sorts_what_it_looks_for_among_many_keys(monkeypatch):
    draw = np.random.default_rng(4)
    keys = np.unique(draw.integers(0, 1 << 63, 5000).astype(np.uint64))
    wanted = np.concatenate([draw.choice(keys, 3000), draw.integers(0, 1 << 63, 500).astype(np.uint64)])
    plain = suffix_tree.find(keys, wanted)
    monkeypatch.setattr(suffix_tree, "MANY", 10)
    assert all((one == two).all() for one, two in zip(plain, suffix_tree.find(keys, wanted)))
    assert plain[1][:3000].all() and not plain[1][3000:].all()
