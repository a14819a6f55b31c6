"""Repetition, personal data, pair defects, leaks, mixing and abuse."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dictaspark.llm import p1_repetition as p1
from dictaspark.llm import p4_personal as p4
from dictaspark.llm import p5_pairs as p5
from dictaspark.llm import p7_leaks as p7
from dictaspark.llm import p8_mixing as p8
from dictaspark.llm import p9_abuse as p9
from dictaspark.session import table


# --- repetition


def share(text):
    w = p1.words_of(text)
    hit, seen = [False] * len(w), set()
    for k in range(len(w) - 3):
        run = tuple(w[k : k + 4])
        if run in seen:
            hit[k : k + 4] = [True] * 4
        seen.add(run)
    return sum(hit) / len(w) if w else 0.0


def test_repetition_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(k, " ".join(f"w{rng.randrange(rng.choice([3, 8, 60]))}" for _ in range(rng.randrange(0, 60))), "a clean text with other words %d" % k, 1.0) for k in range(300)]
    rows += [(900, None, None, 0.0), (901, "", "", 0.0), (902, "a b c d " * 5000, None, 0.0), (903, "one two three", None, 0.0), (902, "a b c d " * 5000, None, 0.0)]
    df = spark.createDataFrame(rows, "row_id bigint, dirty string, clean string, score double")
    want = sorted(r[0] for r in rows if share(r[1]) >= 0.4)
    assert sorted(r["row_id"] for r in p1.repetition(df).filter("candidate and share >= 0.4").collect()) == want
    exact = {r["row_id"]: r["share"] for r in p1.repetition(df).collect()}
    assert all(abs(exact[r[0]] - share(r[1])) < 1e-9 for r in rows)
    assert p1.repetition(df.limit(0)).count() == 0


def test_repetition_on_data(spark, sf):
    rows = table(spark, sf, "contribs")
    want = {r["row_id"] for r in rows.select("row_id", "dirty").collect() if share(r["dirty"]) >= 0.4}
    assert {r["row_id"] for r in p1.repetition(rows).filter("candidate and share >= 0.4").collect()} == want


def test_bound_is_a_bound():
    rng = np.random.default_rng(2)
    for _ in range(50):
        raw, target = rng.integers(0, 9, 2 * p1.BUCKETS), np.concatenate([rng.integers(0, 9, p1.BUCKETS), np.zeros(p1.BUCKETS, int)])
        ratio = p1.log_ratios(raw * 1.0, target * 1.0)
        q = rng.uniform(0.1, 1)
        score = q * ratio[p1.BUCKETS :].min() + (1 - q) * ratio[: p1.BUCKETS].min()
        assert score >= p1.bound(ratio, 0.4) > 0


def test_the_ratio_turns_documents_away(spark, sf):
    """Most documents without loops, and some with few, score below the bound; without the ratio of repeats no loop is found."""
    out = p1.repetition(table(spark, sf, "contribs"))
    n, kept, low = out.agg(F.count("*"), F.count_if("candidate"), F.count_if(F.expr("share > 0 and not candidate"))).first()
    assert 0 < kept < n / 2 and low > 0


# --- personal data


@pytest.fixture(scope="module")
def model():
    given, family = frozenset(["alice", "hugo", "nora", "marc"]), frozenset(["martin", "lebrun", "tinderby", "o'quillan", "holloway", "perlowe"])
    texts = ["the call with hugo starts at four thirty p m and nora lost the badge", "alice asked for it twice and marc spoke for an hour",
             "order 2351 is closed and the serial is 2233716163 on the back", "this was dictated for alice martin", "la plainte vient de nora lebrun encore"] * 40
    weights, common = p4.fit(texts, given, family)
    return weights, common, given, family


@pytest.mark.parametrize("text,kinds", [
    ("write to hugo.martin@firm.test now", ["email"]), ("write to hugo dot um martin at firm dash one dot test", ["email"]), ("questions go to support@example.com", []),
    ("écris à nora tiret bas lebrun arobase poste point test", ["email"]), ("call +44 (0)2079 460108 after lunch", ["phone"]), ("au 06 12 34 56 78 merci", ["phone"]),
    ("call oh two zero seven nine four six oh four two four", ["phone"]), ("on the form I put 972-13-1389", ["id_number"]), ("it is ch66 9999 9803 3983 8376 2 in the record", ["id_number"]),
    ("the serial is 2233716163 on the back", []), ("order 12345 is closed", []), ("we moved to 12 silver birch lane last week", ["street_address"]),
    ("la clé est au 45 ter impasse vieux-lavoir", ["street_address"]), ("we took the same road and the street was closed at 9", []), ("hugo asked for it twice", []),
    ("dictated for Alice Martin again", ["person_name"]), ("signed lebrun, nora as usual", ["person_name"]), ("ask for Dr Holloway at the desk", ["person_name"]),
    ("", []), (None, []), ("   ", []),
])
def test_personal_cases(model, text, kinds):
    assert sorted({k for *_, k in p4.find(text, model)}) == kinds


def test_redaction_keeps_the_rest(model):
    text = "Hi, write to hugo.martin@firm.test or call +44 2079 460108, thanks."
    assert p4.redact(text, p4.find(text, model)) == "Hi, write to [EMAIL] or call [PHONE], thanks."
    long = "plain words here " * 20_000 + text
    assert p4.redact(long, p4.find(long, model)).endswith("[EMAIL] or call [PHONE], thanks.")


def test_decode_is_the_best_set():
    rng = random.Random(3)
    for _ in range(100):
        segs = [(a := rng.randrange(20), a + rng.randrange(1, 6), "k", rng.uniform(-1, 3)) for _ in range(7)]

        def best(k, end):
            if k == len(order):
                return 0.0
            a, b, _, s = order[k]
            skip = best(k + 1, end)
            return max(skip, s + best(k + 1, b)) if a >= end else skip

        order = sorted(segs, key=lambda x: (x[0], x[1]))
        got = p4.decode(segs)
        total = sum(max(s for a2, b2, _, s in segs if (a2, b2) == (a, b)) for a, b, _ in got)
        assert abs(total - best(0, -1)) < 1e-9


def test_marginals_add_up():
    probs = p4._marginals([(0, 2, 0.0), (1, 3, 0.0)])
    assert all(abs(p - 1 / 3) < 1e-9 for p in probs)


def test_personal_rows(spark, sf):
    names = table(spark, sf, "name_list")
    rows = table(spark, sf, "contribs").withColumn("field", F.lit(1)).withColumn("kind", F.lit("x"))
    assert p4.redacted(rows, names).count() == rows.count()
    assert p4.found(rows.limit(0), names).count() == 0
    odd = spark.createDataFrame([(1, None, None), (1, None, None), (2, "", " ")], "row_id bigint, dirty string, clean string")
    assert p4.found(odd, names.limit(0)).count() == 0


def test_the_model_is_that_of_all_texts(spark):
    """Words are counted, and weights fitted, over every row: the same as in memory, whatever the partitions."""
    rng = random.Random(4)
    people = ["alice martin", "nora lebrun", "hugo tinderby", "marc ate soup", "lebrun, nora", "alice perlowe"]
    rows = [(k, f"um the note w{k % 199} was for {rng.choice(people)} at {rng.randrange(99)} mill lane v{k % 101}", None if k % 3 else f"serial {rng.randrange(10**9, 10**10)} or +44 2079 46010{k % 10}") for k in range(2400)]
    df = spark.createDataFrame(rows, "row_id bigint, dirty string, clean string")
    listed = [("alice", "given"), ("nora", "given"), ("hugo", "given"), ("marc", "given"), ("martin", "family"), ("lebrun", "family"), ("tinderby", "family")]
    names = spark.createDataFrame(listed, "entry string, kind string")
    texts = [t for r in rows for t in r[1:] if t]
    given, family = (frozenset(e for e, kind in listed if kind == k) for k in ("given", "family"))
    weights, common = p4.fit(texts, given, family)
    least = len(texts) // 200
    often = {f"w{k}" for k in range(199) if sum(r[0] % 199 == k for r in rows) >= least} | {f"v{k}" for k in range(101) if sum(r[0] % 101 == k for r in rows) >= least}
    assert often and {w for w in common if w[0] in "wv" and w[1:].isdigit()} == often
    for parts in (3, 7):
        got = p4.model_of(df.repartition(parts), names)
        assert got[1:] == (common, given, family)
        assert got[0].keys() == weights.keys() and max(abs(got[0][k] - w) for k, w in weights.items()) < 1e-6


def test_a_text_is_the_product_of_its_runs():
    rng = random.Random(6)
    for _ in range(30):
        segs = [(a := rng.randrange(30), a + rng.randrange(1, 5), "phone", [f"x{k}"], False) for k in range(8)]
        parts = p4.Counter()
        assert p4._tally(parts, segs) == parts.total()
        keys, block = p4._block(parts)
        weights = np.array([rng.uniform(-1, 1) for _ in keys])
        at = dict(zip(keys.tolist(), weights))
        scores = [(a, b, at[p4.key("phone", "")] + at[p4.key("phone", f[0])]) for a, b, _, f, _ in segs]
        probs, z = p4._lattice(scores)
        slope, value = p4._slopes(weights, block)
        assert abs(value / p4.UNIT + z) < 1e-6
        want = {p4.key("phone", f"x{k}"): -p for k, p in enumerate(probs)} | {p4.key("phone", ""): -sum(probs)}
        assert all(abs(want[k] - g / p4.UNIT) < 1e-6 for k, g in zip(keys.tolist(), slope))


# --- pair defects


@pytest.fixture(scope="module")
def tagger(spark, sf):
    rows = table(spark, sf.replace("sf0.001", "sf0.01"), "contribs").select("dirty", "clean").limit(900).collect()
    return p5.train(p5.planted(sorted((r[0], r[1]) for r in rows if r[0] and r[1])))


DIRTY = "um the garden behind the house needs seven bags of soil and nobody has touched the release note since april so please read the survey aloud once before you send it to the board"
CLEAN = "The garden behind the house needs 7 bags of soil and nobody has touched the release note since April. So please read the survey aloud once before you send it to the board."


@pytest.mark.parametrize("dirty,clean,defect", [
    (DIRTY, CLEAN, None), (DIRTY, None, "empty"), (DIRTY, " .. ", "empty"), ("um uh", None, None), ("", "", None), (None, None, None),
    (DIRTY, CLEAN[:60], "truncated"), (DIRTY, "I'm sorry, but I cannot help with this request.", "refusal"), (DIRTY, f"  {DIRTY}\n", "copy"),
    (DIRTY, "Le jardin derrière la maison demande 7 sacs de terre et personne n'a touché à la note depuis avril. Donc relis le sondage à voix haute avant de l'envoyer.", "other_language"),
    (DIRTY + " the sign reads fermé le lundi", CLEAN + " The sign reads fermé le lundi.", None),
    ((DIRTY + " ") * 4, CLEAN, None),
    ("unfortunately I am not able to read the roadmap before monday and the lab wants the draft", "Unfortunately I am not able to read the roadmap before Monday and the lab wants the draft.", None),
])
def test_defects(tagger, dirty, clean, defect):
    assert p5.defects([(dirty, clean)], tagger)[0][0] == defect


def test_growth_is_the_common_subsequence():
    rng = random.Random(4)
    for _ in range(200):
        a = [rng.choice("abcde") for _ in range(rng.randrange(0, 14))]
        b = [rng.choice("abcde") for _ in range(rng.randrange(0, 14))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        grown, lengths = p5.growth(a, b)
        assert grown.bit_count() == t[-1][-1] and (not b or lengths[-1] == t[-1][-1])


def test_viterbi_against_brute_force():
    import itertools

    rng = np.random.default_rng(5)
    trans = rng.normal(size=(5, 5))
    emits = [rng.normal(size=(n, 5)) for n in (1, 2, 4)]
    for e, tags in zip(emits, p5.viterbi(emits, trans)):
        value = lambda y, e=e: sum(e[t, k] for t, k in enumerate(y)) + sum(trans[a, b] for a, b in zip(y, y[1:]))
        assert abs(value(tags) - max(value(y) for y in itertools.product(range(5), repeat=len(e)))) < 1e-9


def test_held_out_accuracy(spark, sf, tagger):
    rows = table(spark, sf.replace("sf0.001", "sf0.01"), "contribs").orderBy(F.desc("row_id")).limit(400).collect()
    held = p5.planted(sorted((r["dirty"], r["clean"]) for r in rows if r["dirty"] and r["clean"]))
    good = sum(np.array_equal(p5.viterbi([p5.emissions(x, words, tagger[0])], tagger[1])[0], y) for x, words, y in held)
    assert good / len(held) > 0.9


@pytest.mark.parametrize("clean", [
    "Ogród za domem potrzebuje siedmiu worków ziemi i nikt nie dotykał notatki od kwietnia. Proszę przeczytać ankietę na głos przed wysłaniem jej do zarządu.",
    "Саду за домом нужно семь мешков земли, и никто не трогал заметку с апреля. Пожалуйста, прочтите опрос вслух перед отправкой.",
    "家の裏の庭には土が七袋必要で、四月以来誰もリリースノートに触れていません。送る前に一度声に出して読んでください。",
    "Evin arkasındaki bahçe yedi torba toprak istiyor ve nisandan beri kimse nota dokunmadı. Lütfen göndermeden önce anketi sesli okuyun.",
])
def test_any_other_language(tagger, clean):
    assert p5.defects([(DIRTY, clean)], tagger)[0][0] == "other_language"


def test_words_decide_refusals(spark, sf, tagger):
    """Without the hashed words a good part of the refusals is taken for something else."""
    rows = table(spark, sf.replace("sf0.001", "sf0.01"), "contribs").select("dirty", "clean").collect()
    without = (tagger[0].copy(), tagger[1])
    without[0][p5.FEATURES :] = 0
    pairs = [(r[0], r[1]) for r in rows if r[0] and r[1]]
    full, bare = (sum(d == "refusal" for d, _ in p5.defects(pairs, m)) for m in (tagger, without))
    assert full > 20 and bare < full


def test_pair_rows(spark):
    odd = spark.createDataFrame([(1, None, None, "d"), (1, "hello there", None, "d"), (2, "x " * 50_000, "y", "d")], "row_id bigint, dirty string, clean string, defect string")
    out = p5.tagged(odd).collect()
    assert len(out) == 3 and [r["defect"] for r in out if r["row_id"] == 1] == [None, "empty"]
    assert p5.tagged(odd.limit(0)).count() == 0


# --- leaks


def brute(docs, items):
    grams = {}
    for i, text in items:
        w = p7.words_of(text)
        for k in range(len(w) - 11):
            grams.setdefault(" ".join(w[k : k + 12]), set()).add(i)
    out = set()
    for d, text in docs:
        w = p7.words_of(text)
        for k in range(len(w) - 11):
            out |= {(d, i) for i in grams.get(" ".join(w[k : k + 12]), ())}
    return out


def test_leaks_on_data(spark, sf):
    docs, items = table(spark, sf.replace("sf0.001", "sf0.01"), "documents"), table(spark, sf, "eval_items")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert want and {(r["doc_id"], r["item_id"]) for r in p7.leaks(docs, items).filter("verbatim").collect()} == want


def test_leaks_edges(spark):
    item = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike"
    docs = [(1, item.upper().replace(" ", ", "), "a"), (2, "x " * 20_000 + item[: -len(" mike")], "a"), (3, " ".join(item.split()[:11]), "a"), (4, None, "a"), (5, "", "a"), (1, item, "a"),
            (6, "alpha um bravo charlie délta écho foxtrot golf hotel india juliet euh kilo lima", "a")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string")
    i = spark.createDataFrame([(7, item, 0.0), (8, "too short", 0.0), (9, None, 0.0)], "item_id bigint, text string, cosine double")
    got = sorted((r["doc_id"], r["item_id"]) for r in p7.leaks(d, i).filter("verbatim").collect())
    assert got == [(1, 7), (1, 7), (2, 7), (6, 7)]
    assert p7.leaks(d.limit(0), i).count() == 0 and p7.leaks(d, i.limit(0)).count() == 0


def test_decomposition_is_singular(spark):
    """Singular values and vectors against a full decomposition of the same passages."""
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(40) + 40 * (k % 3)}" for _ in range(30)) for k in range(60)]
    idf = np.ones(p7.TERMS)
    basis, value = p7.decompose(spark.createDataFrame([(t, True) for t in texts], "text string, item boolean"), idf, rank=8)
    rows = []
    for t in texts:
        for passage in p7.item_passages(p7.words_of(t)):
            term, weight = p7.weighted(p7.codes_of(passage), idf)
            row = np.zeros(p7.TERMS)
            row[term] = weight
            rows.append(row)
    full = np.linalg.svd(np.array(rows), compute_uv=False)
    assert np.allclose(basis.T @ basis, np.eye(8), atol=1e-4) and np.allclose(value[:3], full[:3], rtol=0.02) and np.allclose(value, full[:8], rtol=0.1)
    assert np.allclose(np.linalg.norm(np.array(rows) @ basis[:, :3], axis=0), value[:3], rtol=0.02)


def test_index_recall_against_brute_force():
    rng = np.random.default_rng(4)
    items = [(k, [f"w{x}" for x in rng.integers(0, 300, 40)]) for k in range(60)]
    basis = np.linalg.qr(rng.standard_normal((p7.TERMS, 32)))[0].astype(np.float32)
    index = p7.Index(items, basis, np.ones(p7.TERMS))
    passage = (index.query[rng.integers(0, len(index.query), 400)] * 0.6 + rng.standard_normal((400, 32)) * 0.05).astype(np.float32)
    want = {(int(a), int(index.owner[b])) for a, b in zip(*np.nonzero(passage @ index.query.T >= 0.5))}
    got = {(int(a), int(b)) for a, b, _ in zip(*index.near(passage, 0.5))}
    assert want and got <= want and len(got) / len(want) >= 0.95


def test_paraphrases_are_found(spark, sf):
    """Items with every fifth word exchanged hold no run of 12 words; nearly all are found, by cosine, order and answers."""
    docs, items = table(spark, sf.replace("sf0.001", "sf0.01"), "documents").select("doc_id", "text"), table(spark, sf, "eval_items")
    rng, plain = random.Random(9), "very much often today there again".split()
    planted = []
    for r in items.collect():
        w = p7.words_of(r["text"])
        if len(w) >= 24:
            planted.append((10**9 + r["item_id"], " ".join(rng.choice(plain) if k % 5 == 4 else x for k, x in enumerate(w))))
    out = p7.leaks(docs.unionByName(spark.createDataFrame(planted, "doc_id bigint, text string")), items, measure=True).filter("leak")
    got = {(r["doc_id"], r["item_id"]) for r in out.filter("not verbatim").collect()}
    hit = sum((d, d - 10**9) in got for d, _ in planted)
    assert hit / len(planted) > 0.9 and sum(d < 10**9 for d, _ in got) < 0.05 * docs.count()


# --- mixing


def sized(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source_name string, tokens bigint")


def test_mixture_meets_targets(spark):
    rng = random.Random(7)
    docs = sized(spark, [(k, "abc"[k % 3 if k % 2 else 0], rng.randrange(5, 50)) for k in range(3000)])
    targets = spark.createDataFrame([("a", 0.4, 1), ("B ", 0.3, 3), ("c", 0.3, 1)], "source_name string, target_share double, max_repeats int")
    rows = {r["source_name"]: r for r in p8.shares(docs, targets).collect()}
    assert all(abs(r["reached_share"] - r["weight"]) < 0.002 for r in rows.values())
    assert abs(rows["a"]["weight"] / rows["b"]["weight"] - 4 / 3) < 0.01 and abs(sum(r["reached_share"] for r in rows.values()) - 1) < 0.005
    assert rows["c"]["missed"] and [r["source_name"] for r in p8.shortfalls(docs, targets).collect()] == ["c"]
    mix = p8.mixture(docs, targets)
    assert mix.groupBy("source_name").agg(F.max("repeats").alias("m")).filter("(source_name = 'a' and m > 1) or (source_name = 'b' and m > 3)").count() == 0
    assert mix.select("doc_id").distinct().count() == mix.count()


def test_exponent_meets_the_limit():
    natural, target = np.array([0.5, 0.5]), np.array([0.1, 0.9])
    weight, own = p8.weights(natural, target, np.array([1.0, 1.0]))
    assert np.allclose(weight, target) and (own == 1.0).all()
    for share_out in (True, False):
        weight, own = p8.weights(natural, target, np.array([1.0, 0.7]), share_out=share_out)
        assert np.allclose(weight, [0.3, 0.7], atol=1e-6) and 0 < own[1] < 1
    assert abs(p8.entropy_of(p8.weights(np.array([0.7, 0.2, 0.1]), np.array([0.3, 0.3, 0.4]), np.full(3, 9.0), entropy=1.0)[0]) - 1.0) < 1e-6


def test_weights_against_filled_targets():
    """With sharing out, weights are the targets raised by one factor and held at the limits, whatever the path."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 12))
        natural, target, repeats = rng.dirichlet(np.ones(n)), rng.dirichlet(np.ones(n)), rng.integers(1, 5, n)
        limit = natural * repeats
        low, high = 0.0, 1e9
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if np.minimum(limit, mid * target).sum() < 1 else (low, mid)
        assert np.abs(p8.weights(natural, target, limit)[0] - np.minimum(limit, high * target)).max() < 1e-4
        single, own = p8.weights(natural, target, limit, share_out=False)
        assert abs(single.sum() - 1) < 1e-9 and (single <= limit * (1 + 1e-6)).all() and len(set(own)) == 1


def test_mixing_edges(spark):
    docs = spark.createDataFrame([(1, " Web", "hello world"), (2, None, "x"), (3, "web", None), (4, "other", "y"), (1, "web", "hello world")], "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("web", 0.9, None), ("gone", 0.1, 2)], "source_name string, target_share double, max_repeats int")
    s = p8.sized(docs, targets)
    assert sorted((r["doc_id"], r["tokens"]) for r in s.collect()) == [(1, 2), (1, 2), (3, 0)]
    assert [r["source_name"] for r in p8.shortfalls(s, targets).collect()] == ["gone"]
    assert p8.mixture(p8.sized(docs.limit(0), targets), targets).count() == 0
    with pytest.raises(ValueError):
        p8.plan(s, targets.union(targets))


# --- abuse


@pytest.mark.parametrize("text,want", [
    ("You i-d-i-o-t", ["you", "idiot"]), ("you m0r0n", ["you", "moron"]), ("mooooron", ["moron"]), ("i d i o t here", ["idiot", "here"]), ("s**t", ["s*4t"]),
    ("v.o.r.t", ["vort"]), ("crétiin", ["cretin"]), ("at 5:40pm $1,620", ["at", "0", "0"]), (None, []), ("um uh", []),
])
def test_normalised_terms(want, text):
    assert p9.terms_of(text) == want


def planted_docs(n, seed):
    rng = random.Random(seed)
    plain = ["the budget moves up this quarter", "please read the draft aloud once", "the chair had the word idiot struck from the minutes", "we moved the cables again", "the recipe needs more flour"]
    bad = ["you are a worthless idiot", "shut your mouth you stupid moron", "get lost you disgusting m0ron", "i hope you choke on it you i-d-i-o-t"]
    texts, labels = [], []
    for _ in range(n):
        y = int(rng.random() < 0.25)
        parts = rng.sample(plain, 4)
        if y:
            parts.insert(rng.randrange(4), rng.choice(bad))
        texts.append(". ".join(parts))
        labels.append(y)
    return texts, labels


def test_abuse_held_out_accuracy():
    texts, labels = planted_docs(400, 1)
    noisy = [1 - y if k % 29 == 0 else y for k, y in enumerate(labels)]
    machine, masked = p9.fit(texts, noisy)
    test, truth = planted_docs(300, 2)
    got = (machine.best([p9.codes_of(p9.terms_of(t), masked) for t in test]) > 0).astype(int)
    assert sum(a == b for a, b in zip(got, truth)) / len(truth) > 0.97


def test_interactions_decide():
    """An insult with a group is abuse, one that is reported is not, though each word stands on both sides equally often."""
    rng = random.Random(5)
    calm = "the draft plan room table garden report cable budget letter music window river paper chair".split()

    def doc(y):
        insult, group = rng.choice(["vermin", "scum", "filth"]), rng.choice(["ostrines", "taloviens", "meshkari"])
        report = rng.choice(["quoted", "minutes", "transcript"])
        # both kinds of document hold an insult, a group and a report word; only what stands together differs
        near, far = ([insult, group], [report]) if y else ([insult, report], [group])
        pad = lambda n: [rng.choice(calm) for _ in range(n)]
        return " ".join([*pad(12), *near, *pad(12), *far, *pad(12)])

    y = [k % 2 for k in range(600)]
    machine, masked = p9.fit([doc(k) for k in y], y)
    test = [p9.codes_of(p9.terms_of(doc(k)), masked) for k in y]
    right = lambda: np.mean((machine.best(test) > 0) == np.array(y))
    with_factors = right()
    machine.v[:] = 0
    assert with_factors > 0.95 and right() < 0.7


def test_machine_is_a_factorization_machine():
    m = p9.Machine()
    part = [3, 5, 9]
    m.w[3] = 0.5
    want = m.b + m.w[part].sum() + sum(float(m.v[a] @ m.v[b]) for a, b in ((3, 5), (3, 9), (5, 9)))
    assert abs(float(m.best([part])[0]) - want) < 1e-5
    docs = [[], list(range(23)), [4], list(range(10))]
    parts, owner = p9._windows([d for d in docs if d])
    score, doc, _ = m.scores(docs)
    assert [1, 1, 1, 1, 2, 3] == doc.tolist() and len(owner) == len(doc) and m.best(docs)[0] == -np.inf


def test_abuse_rows(spark):
    texts, labels = planted_docs(120, 3)
    docs = spark.createDataFrame([(k, t, " Web " if k % 2 else None, 0.5) for k, t in enumerate(texts)] + [(900, None, "", 0.1), (901, "a " * 30_000, "x", 0.1)], "doc_id bigint, text string, source string, score double")
    marks = spark.createDataFrame([(k, y) for k, y in enumerate(labels)] + [(0, None), (5, 0), (5, 1), (None, 1)], "doc_id bigint, toxic int")
    scores = p9.scored(docs, marks)
    assert scores.count() == 122 and scores.filter("doc_id = 900 and score = 0.0").count() == 1
    assert {r["source"] for r in p9.rates(scores).collect()} == {"web", "unknown", "x"}
    assert p9.scored(docs, marks.limit(0)).filter("score > 0").count() == 0
    assert p9.scored(docs.limit(0), marks).count() == 0
