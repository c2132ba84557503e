"""Operators 2, 4, 5, 7, 8 and 9 against plain Python, with nulls, blanks, copies, repeated rows, clashing names and empty tables."""

import hashlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxloom.llm import common, decontaminate, jaccard_join, language_model, line_dedup, private_data, quality_rules

LABELS = "doc_id long, quality int, toxic int"


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


@pytest.mark.parametrize("table", ["docs", "clashing"])
def test_line_dedup(table, texts, request):
    got = rows(line_dedup.deduplicated(request.getfixturevalue(table)))
    want = brute.line_dedup(texts)
    assert {d: (r["n_lines"], r["n_dropped"], brute.sha(r["text"])) for d, r in got.items()} == want
    assert any(n for _, n, _ in want.values())


def test_line_dedup_keeps_other_columns_and_repeated_rows(docs):
    twice = docs.union(docs)
    once, both = rows(line_dedup.deduplicated(docs)), line_dedup.deduplicated(twice).collect()
    assert len(both) == 2 * len(once) and all(r["text"] == once[r["doc_id"]]["text"] for r in both)
    assert {"lang", "source"} <= set(both[0].asDict())


def test_bitmaps_are_run_lengths(spark):
    line = "a line of at least twenty letters"
    text = "\n".join([line, "x", line, line, "y"])
    docs = spark.createDataFrame([(k, text) for k in range(3)], "doc_id long, text string")
    maps = rows(line_dedup.keep_bitmaps(docs))
    assert {d: r["runs"] for d, r in maps.items()} == {0: [0, 1, 1, 2], 1: [0, 1, 1, 2]}


@pytest.mark.parametrize("inline", [decontaminate.MAX_INLINE, 0])
def test_decontaminate(docs, texts, spark, inline):
    items = {7: texts[10], 8: " ".join(texts[61].split()[100:112]), 9: "one two", 10: None, 11: "...", 12: texts[10]}
    table = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = rows(decontaminate.hits(docs, table, max_inline=inline))
    mine = {d: (r["n_words"], r["n_hit"], len(r["item_ids"]), brute.sha(",".join(r["item_ids"])), r["n_hit"] > 0) for d, r in got.items()}
    assert mine == brute.contaminated(texts, items)


def test_decontaminate_without_items_and_with_repeated_rows(docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r["n_hit"] == 0 for r in decontaminate.hits(docs, none).collect())
    assert decontaminate.hits(docs.union(docs), none).count() == 2 * docs.count()


PRIVATE = {
    1: "mail a.b@c.de, x@y.z_q@r.st and a@b", 2: "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.4", 3: "card 4111 1111 1111 1111, 4111111111111112",
    4: "call +1 (017) 555-7713 or +123", 5: None, 6: "", 7: "9" * 3000 + " " + "a" * 20000 + "@", 8: "é +49 30 1234567é a@b.c", 9: "4111-1111-1111-1111x@y.zz",
    10: "1" * 18, 11: "@ . @a.b 7@8.9", 12: "+1.234.567.8901..",
}


def test_private_data(spark):
    docs = spark.createDataFrame(list(PRIVATE.items()), "doc_id long, text string")
    got = rows(private_data.personal_data(docs))
    mine = {d: [(private_data.KINDS[s["kind"]], s["start"], s["end"]) for s in r["base"]] for d, r in got.items()}
    assert mine == {d: brute.spans(t) for d, t in PRIVATE.items()}
    assert all(set(map(tuple, r["base"])) <= set(map(tuple, r["spans"])) for r in got.values())


def test_private_data_learns_from_context(spark):
    seeds = [(k, f"please dial +1 555 {1000 + k} {2000 + k} now") for k in range(40)]
    docs = spark.createDataFrame([*seeds, (90, "please dial 55-1234 now"), (91, "chapter 55-1234 now of the book 1999")], "doc_id long, text string")
    got = rows(private_data.personal_data(docs))
    assert len(got[90]["spans"]) == 1 and got[90]["base"] == []
    assert got[91]["spans"] == got[91]["base"]


def test_private_data_finds_unseen_forms_after_few_seeds(spark):
    """Five distinct seeds a pattern: an e-mail without digits, addresses of other forms, the second of a list."""
    seeds = [(k, f"please write to user{'abcdef'[k]}@host.org soon") for k in range(5)]
    seeds += [(10 + k, f"its peer 10.0.0.{k} answers") for k in range(10)]
    seeds += [(20 + k, f"copies: {x}@a.org {x}@b.org end") for k, x in enumerate("pqrstu")]
    new = [(90, "please write to alice@intranet soon"), (91, "its peer fe80::1 answers"), (92, "its peer 10.0.0.x answers"), (93, "copies: v@a.org bob@intranet end")]
    plain = [(95, "chapter 12 of 2004 and a @ sign"), (96, "its peer answers 17 times"), (97, "room 10.0.0.y or me@home")]
    docs = spark.createDataFrame([*seeds, *new, *plain], "doc_id long, text string")
    got, texts = rows(private_data.personal_data(docs)), dict([*new, *plain])
    more = {d: [(private_data.KINDS[s["kind"]], t[s["start"] : s["end"]]) for s in got[d]["spans"] if s not in got[d]["base"]] for d, t in texts.items()}
    assert more == {90: [("email", "alice@intranet")], 91: [("ip", "fe80::1")], 92: [("ip", "10.0.0.x")], 93: [("email", "bob@intranet")], 95: [], 96: [], 97: []}


def test_jaccard_classes(docs, texts):
    got = {d: (r["n_shingles"], r["component_id"]) for d, r in rows(jaccard_join.link_classes(docs)).items()}
    assert got == brute.classes(texts)
    assert got[25][1] == 10


@pytest.mark.parametrize("frequent", [20, 1_000_000])
def test_jaccard_near_copies_of_all_distances(spark, monkeypatch, frequent):
    """Many edited copies of two texts, some far from all others, so that pivots, hubs, differing shingles, lists of frequent and rare
    shingles and sizes all decide some pairs."""
    import random

    rng = random.Random(3)
    bases = [[f"w{rng.randint(0, 400)}" for _ in range(90)] for _ in range(2)]
    texts = {}
    for k in range(180):
        w = bases[k % 3 == 0][:]
        for _ in range(rng.randint(0, 7 if k % 3 else 4)):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 30)}"
        texts[k] = " ".join(w[: rng.choice([90, 90, 80, 70])])
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    got = {d: (r["n_shingles"], r["component_id"]) for d, r in rows(jaccard_join.link_classes(table)).items()}
    assert got == brute.classes(texts)
    assert 3 < len({c for _, c in got.values()}) < 150


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_components_of_chains_stars_and_single_links(spark, monkeypatch, most):
    monkeypatch.setattr(common, "MOST_LINKS", most)
    links = [(-k, -k - 1) for k in range(40)] + [(100 + 7 * k % 50, 100 + 7 * (k + 1) % 50) for k in range(49)] + [(200, 300 + k) for k in range(30)] + [(400, 399), (500, 500)]
    want = {-k: -40 for k in range(41)} | {100 + k: 100 for k in range(50)} | {200: 200} | {300 + k: 200 for k in range(30)} | {399: 399, 400: 399}
    for some in (links, links[:0]):
        got = common.components(spark.createDataFrame(some, "a long, b long"), "a", "b").collect()
        assert len(got) == len({r["node"] for r in got}) and {r["node"]: r["root"] for r in got} == (want if some else {})


def test_components_of_many_random_links():
    rng = np.random.default_rng(2)
    u, v = rng.integers(0, 3000, (2, 1500))
    nodes, root = common.reached(u, v)
    parent = dict(zip(nodes.tolist(), nodes.tolist(), strict=True))
    for _ in range(len(u)):
        before = dict(parent)
        for x, y in zip(u.tolist(), v.tolist(), strict=True):
            parent[x] = parent[y] = min(parent[x], parent[y])
        if parent == before:
            break
    assert parent == dict(zip(nodes.tolist(), root.tolist(), strict=True)) and len(set(parent.values())) > 100


def test_components_of_a_long_chain_take_few_jobs(spark):
    """What the driver holds follows the jobs it runs: a round for each doubling of the chain would take more than a hundred."""
    links = spark.createDataFrame([(k, k + 1) for k in range(300)], "a long, b long")
    spark.sparkContext.setJobGroup("chain", "components of a chain")
    try:
        assert {r["root"] for r in common.components(links, "a", "b").collect()} == {0}
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(name, None)
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("chain")) <= 10


def test_pairs_of_lists_are_those_that_differ_in_component_and_pivot():
    import itertools

    rng = np.random.default_rng(5)
    token = np.sort(rng.integers(0, 6, 200))
    sid = np.concatenate([rng.choice(500, k, replace=False) for k in np.bincount(token)])
    n, comp, pivot = (rng.integers(10, 18, 500), rng.integers(0, 3, 500) ** 2, rng.integers(0, 4, 500) // 2)
    want = {}
    for t in range(6):
        for x, y in itertools.combinations(sorted(sid[token == t].tolist()), 2):
            if comp[x] != comp[y] and pivot[x] != pivot[y] and 4 * min(n[x], n[y]) >= 3 * max(n[x], n[y]):
                want[x, y] = want.get((x, y), 0) + 1
    got = {}
    for x, xn, y, yn, c in jaccard_join.list_pairs(token, sid, n[sid], comp[sid], pivot[sid]):
        assert (n[x] == xn).all() and (n[y] == yn).all()
        for pair, k in zip(zip(x.tolist(), y.tolist(), strict=True), c.tolist(), strict=True):
            got[pair] = got.get(pair, 0) + k
    assert got == want and len(want) > 100


def test_quality_statistics(docs, texts, spark):
    labels = spark.createDataFrame([], LABELS)
    got = rows(quality_rules.judged(docs, labels))
    mine = {d: (s["n_words"], s["word_chars"], s["n_symbols"], s["lines"]["dup"], s["n_repeat_words"], r["base_failed"]) for d, r in got.items() for s in [r["_s"]]}
    assert mine == {d: brute.statistics(t) for d, t in texts.items()}
    assert all(r["kept"] == (not r["base_failed"]) for r in got.values())


def test_repeats_of_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "PACKED", 64)
    text = " ".join(["a b c d"] * 5 + [f"w{k}" for k in range(100)])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality_rules.statistics(docs).first()["_s"]["n_repeat_words"] == brute.statistics(text)[4]


def test_decision_list_is_learned_on_what_the_base_rules_leave(spark):
    """Short documents with labels of both kinds don't hide a rule that separates the others."""
    import random

    rng = random.Random(2)
    text = lambda n, mark: " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 999)}{mark if rng.random() < 0.4 else ''}" for _ in range(n))
    made = [(k, text(20, ""), k % 2) for k in range(60)] + [(100 + k, text(80, "$$"), 0) for k in range(40)] + [(200 + k, text(80, ""), 1) for k in range(100)]
    docs = spark.createDataFrame([m[:2] for m in made], "doc_id long, text string")
    labels = spark.createDataFrame([(d, q, 0) for d, _, q in made], LABELS)
    got = rows(quality_rules.judged(docs, labels))
    assert [d for d, r in got.items() if r["kept"]] and {d for d, r in got.items() if r["kept"]} == set(range(200, 300))
    assert all(r["base_failed"] == (d < 60) for d, r in got.items())


def test_decision_list_separates_and_is_ordered():
    rows = [({f: 0.0 for f in quality_rules.FEATURES} | {"symbol_share": 0.5 if k % 4 == 0 else 0.01 * (k % 3), "words": float(k)}, k % 4 == 0) for k in range(400)]
    rules = quality_rules.learn(rows)
    assert len(rules) == 1 and rules[0][0].feature == "symbol_share"
    assert quality_rules.score(rules[0], rows) == (100, 0)
    assert quality_rules.learn([]) == []


def test_language_model(docs, texts):
    got = rows(language_model.scored(docs))
    for d, (held, n, known, train, base) in brute.base_scores(texts).items():
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, train)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0


def test_language_model_slices_agree(docs):
    one, many = rows(language_model.scored(docs)), rows(language_model.scored(docs, most=20))
    assert len(one) == len(many)
    for d, r in one.items():
        assert (many[d]["base_score"], many[d]["score"]) == pytest.approx((r["base_score"], r["score"]), rel=1e-6)
        assert (many[d]["n_tokens"], many[d]["n_known"]) == (r["n_tokens"], r["n_known"])


def test_word_keys_depend_on_the_word_alone():
    words = ["a", "ab", "ba", "é", "y" * 64, "z" * 65, "z" * 500, "\n", "aa", *(f"w{k}" for k in range(300))]
    keys = language_model.word_keys(pa.array(words))
    assert len(set(keys.tolist())) == len(words)
    assert (language_model.word_keys(pa.array(words).slice(3, 40)) == keys[3:43]).all()
    assert [int(language_model.word_keys(pa.array([w]))[0]) for w in words] == keys.tolist()
    assert len(language_model.word_keys(pa.array([], pa.string()))) == 0


def test_language_model_learns_words_within_a_class(spark):
    """All words end alike and are about as frequent, so that classes tell them into four bands at most."""
    text = " ".join([f"w{k}xx" for k in range(64)] * 4)
    docs = spark.createDataFrame([(k, text) for k in range(60)], "doc_id long, text string")
    held = [r for r in language_model.scored(docs).collect() if r["held_out"]]
    assert held and sum(r["score"] for r in held) > 0.6 * sum(r["base_score"] for r in held)


@pytest.mark.parametrize("levels", [0, 3, 30])
def test_language_model_word_factor_sums_to_one(levels):
    keys = language_model.word_keys(pa.array([f"word{k}" for k in range(500)]))
    counts = np.arange(1, 501)
    ending = (keys & np.uint64(language_model.ENDINGS - 1)).astype(np.int64)
    classes = language_model.Classes([(int(c), int(e), 1) for c, e in zip(counts, ending, strict=True)])
    model = language_model.Model(classes)
    model.learn_counts(classes, iter([language_model.Slice(keys, counts, 0, 1)]))
    model.moved = levels
    model.of_tree[:] = np.random.default_rng(1).normal(0, 1, 1 << model.tree_bits)
    of = classes.of(counts, ending)
    assert (model.trained_class(keys) == of).all()
    hashes = tuple(np.full(500, h, np.uint64) for h in (5 << 60, 7 << 55, 9 << 58))
    logs = classes.word_log10(counts, of) + model.tree_log10(model.paths(keys, of), np.arange(500), hashes)
    for k in range(language_model.CLASSES):
        n, words = classes.tokens[k], classes.words[k]
        spare = 0.5 / (n + 0.5 * (words + 1)) if k < language_model.ENDINGS else 0
        assert (10 ** logs[of == k]).sum() + spare == pytest.approx(1, rel=1e-4)


def test_language_model_beats_words_alone(spark):
    """Held-out text that follows an order the model can learn."""
    text = " ".join(["red green blue stop"] * 40)
    docs = spark.createDataFrame([(k, text) for k in range(60)], "doc_id long, text string")
    held = [r for r in language_model.scored(docs).collect() if r["held_out"]]
    assert held and sum(r["score"] for r in held) > 0.9 * sum(r["base_score"] for r in held)


def test_empty_tables(empty, spark):
    items, labels = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([], LABELS)
    for got in (
        line_dedup.deduplicated(empty), decontaminate.hits(empty, items), private_data.personal_data(empty), jaccard_join.link_classes(empty),
        quality_rules.judged(empty, labels), language_model.scored(empty),
    ):
        assert got.count() == 0


def test_clashing_names(clashing, spark):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    labels = spark.createDataFrame([(10, 1, 0), (40, 0, 0), (40, None, 0)], LABELS)
    n = clashing.count()
    assert decontaminate.hits(clashing, items).count() == n
    assert private_data.personal_data(clashing).count() == n
    assert jaccard_join.link_classes(clashing).count() == n
    assert quality_rules.judged(clashing, labels).count() == n
    assert language_model.scored(clashing).count() == n


def test_native_operators_run_no_python(docs, spark):
    items, labels = spark.createDataFrame([(1, "one two")], "item_id long, text string"), spark.createDataFrame([], LABELS)
    for got in (line_dedup.deduplicated(docs), decontaminate.hits(docs, items), private_data.personal_data(docs), quality_rules.judged(docs, labels)):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_sha_of_no_spans():
    assert hashlib.sha256(b"").hexdigest() == brute.sha("")
    assert F is not None
