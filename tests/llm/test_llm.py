"""The operators of the llm subpackage against plain versions and on odd input."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarrystone.llm import encoding, grouped_splits, mixing, overlap, subjects, superpose

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def table():
    return encoding.WordTable(encoding.TrieEncoder.load(encoding.VOCABULARY))


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    return t


def _ids(table, texts):
    counts, ids = table.encode(texts)
    return [x.tolist() for x in np.split(ids.to_numpy(), np.cumsum(counts)[:-1])]


ODD = [None, "", " ", "a\x1cb\x85", "<|endoftext|> x", "don't I'LL", "\r\n\t  y", "é" * 500, "a" * 20_000, "0123456789" * 500, "日本語 한국어", "x\x0b\x0cy"]


def test_ids_are_the_tokenizers(table, reference):
    assert _ids(table, ODD) == [reference.encode(t or "", add_special_tokens=False).ids for t in ODD]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), min_size=1, max_size=5))
def test_ids_of_any_text(table, reference, texts):
    assert _ids(table, texts) == [reference.encode(t, add_special_tokens=False).ids for t in texts]


def test_encode_corpus(spark, reference):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    got = {r["doc_id"]: r["ids"] for r in encoding.encode_corpus(df).collect()}
    assert got == {i: reference.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(ODD)}
    assert encoding.encode_corpus(df.limit(0)).count() == 0


# --- overlap --------------------------------------------------------------------------
def _molecule(seed, n=12):
    rng = np.random.default_rng(seed)
    return rng.choice(list("CCHHHO"), n), rng.normal(0, 2, (n, 3))


def _moved(e, x, seed, noise):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    q *= np.sign(np.linalg.det(q))
    d = rng.normal(size=x.shape)
    p = rng.permutation(len(e))
    return e[p], ((x + noise * d / np.linalg.norm(d, axis=1)[:, None]) @ q + 3)[p]


def _superposable(ea, a, eb, b, tolerance=overlap.TOLERANCE):
    return superpose.superposable(ea, a, eb, b, tolerance)


@pytest.mark.parametrize("seed", range(12))
def test_superposition(seed):
    e, x = _molecule(seed)
    assert _superposable(e, x, *_moved(e, x, seed, 0.049))
    assert not _superposable(e, x, e, x * [-1, 1, 1])
    y = x.copy()
    y[3] += 0.4
    assert not _superposable(e, x, *_moved(e, y, seed, 0.0))


def _shapes(kind, rng):
    turn = np.arange(6) * np.pi / 3
    ring = np.column_stack([np.cos(turn), np.sin(turn), 0 * turn])
    if kind == "ring":
        return np.repeat(["c", "h"], 6), np.concatenate([1.39 * ring, 2.48 * ring])
    if kind == "line":
        n = int(rng.integers(2, 9))
        return np.array(["c"] * n), np.outer(np.arange(n) * 1.3, [1, 0, 0])
    if kind == "alike":
        n = int(rng.integers(8, 13))
        return np.array(["c"] * n), rng.normal(0, 0.6, (n, 3))
    n = int(rng.integers(1, 21))
    return rng.choice(list("cho"), n), rng.normal(0, 2, (n, 3))


@pytest.mark.parametrize("kind", ["ring", "line", "alike", "mixed"])
def test_no_copy_near_the_tolerance_is_missed(kind):
    rng = np.random.default_rng(7)
    missed = 0
    for i in range(250):
        e, x = _shapes(kind, rng)
        missed += not _superposable(e, x, *_moved(e, x, i, 0.0499))
    assert missed == 0


@pytest.mark.parametrize("kind", ["ring", "line", "mixed"])
def test_both_sides_of_the_least_tolerance(kind):
    """The least tolerance at which a pairing holds is bracketed: nothing below it is accepted, everything above is."""
    rng = np.random.default_rng(3)
    for i in range(15):
        e, x = _shapes(kind, rng)
        y = x + rng.normal(0, 0.04, x.shape)
        low, high = 0.0, 1.0
        for _ in range(24):
            middle = (low + high) / 2
            low, high = (low, middle) if superpose.within(x, y, middle) else (middle, high)
        plain = min(
            np.linalg.norm((y - cb) @ r + ca - x, axis=1).max() for w in rng.dirichlet(np.ones(len(x)), 300) for r, ca, cb in [superpose.best_motion(x, y, w)]
        )
        assert high <= plain + 1e-6
        for factor in (1.002, 1.02, 1.5):
            assert superpose.within(x, y, high * factor + 1e-6) and not superpose.within(x, y, high / factor - 1e-6)


def _words(e, x, tolerance):
    return overlap.shape_words(e, x, np.array([len(e)]), tolerance)[:2]


def test_words_move_within_their_bounds():
    for seed in range(40):
        e, x = _molecule(seed)
        (a, bound), (b, _) = _words(e, x, 0.05), _words(*_moved(e, x, seed, 0.05), 0.05)
        assert (np.abs(a - b) <= bound + 1e-9).all()


def test_grams_of_a_near_copy_are_all_hit():
    for seed in range(40):
        e, x = _molecule(seed, 1 + seed % 14)
        own = {}
        for name, (names, xyz) in {"train": (e, x), "eval": _moved(e, x, seed, 0.05)}.items():
            words, bounds, per = overlap.shape_words(names, xyz, np.array([len(names)]), 0.05)
            _, place, n, is_own, gram = overlap.gram_table(words, bounds, per, overlap.CELL)
            own[name] = {(p, g) for p, g, o in zip(place, gram, is_own) if o or name == "eval"}
            assert (n == len(words) - overlap.GRAM_WORDS + 1).all()
        assert own["train"] <= own["eval"]


def test_words_of_many_structures_are_those_of_each():
    parts = [_molecule(s, 1 + s) for s in range(9)]
    every = overlap.shape_words(np.concatenate([e for e, _ in parts]), np.concatenate([x for _, x in parts]), np.array([len(e) for e, _ in parts]), 0.05)
    each = [_words(e, x, 0.05) for e, x in parts]
    assert np.allclose(every[0], np.concatenate([w for w, _ in each])) and (every[1] == np.concatenate([b for _, b in each])).all()
    assert np.allclose(each[4][0][:3], np.linalg.svd(parts[4][1] - parts[4][1].mean(axis=0), compute_uv=False) / np.sqrt(5))


def test_overlap_finds_all_pairs(spark):
    rows = []

    def add(i, split, e, x, charge=0, spin=1):
        rows.append((i, [(str(s), *map(float, p)) for s, p in zip(e, x)] if e is not None else None, charge, spin, split, "v", None))

    molecules = [_molecule(s) for s in range(6)]
    for k, (e, x) in enumerate(molecules):
        add(10 * k, "Train ", e, x)
        add(10 * k + 1, "val", *_moved(e, x, k, 0.03))
        add(10 * k + 2, "test", e, x * [-1, 1, 1])
        add(10 * k + 3, "test", *_moved(e, x, k, 0.01), charge=1)
    add(100, "train", *molecules[0])
    add(101, "test", *molecules[0])
    for i, (m, c, s) in enumerate([(None, 0, "test"), (molecules[0], None, "test"), (molecules[0], 0, None)]):
        add(200 + i, s, *(m or (None, None)), charge=c)
    schema = "struct_id bigint, molecule array<struct<elem:string,x:double,y:double,z:double>>, charge int, spin int, split_name string, vertical string, loaded_at timestamp"
    df = spark.createDataFrame([*rows, rows[0]], schema)
    found = overlap.SplitOverlap(df)
    got = {tuple(r) for r in found.record_pairs().collect()}
    assert got == {(10 * k, 10 * k + 1) for k in range(6)} | {(100, 1), (100, 101), (0, 101)}
    report = {(r["split"], r["vertical"]): r for r in found.report().collect()}
    assert report["test", "v"]["n_overlapping"] == 1 and report["test", "v"]["n_exact"] == 1 and report["val", "v"]["n_links"] == 7
    assert overlap.SplitOverlap(df.limit(0)).record_pairs().count() == 0


# --- grouped splits ---------------------------------------------------------------------
def test_groups_and_splits(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(2000):
        comp = int(rng.integers(0, 400)) if i % 3 else 0
        rows.append((i, [("C", 0.0, 0.0, 0.0)] * (1 + comp) if i % 50 else None, f" Orig-{rng.integers(0, 900)}" if i % 4 == 0 else None, f"v{i % 7}", None))
    df = spark.createDataFrame(rows, "struct_id bigint, molecule array<struct<elem:string,x:double,y:double,z:double>>, origin_ref string, vertical string, loaded_at timestamp")
    groups = grouped_splits.structure_groups(df)
    got = {r["record_id"]: (r["group_id"], r["group_size"]) for r in groups.collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for i, m, o, *_ in rows:
        find(("s", i))
        for key in ([("m", len(m))] if m is not None else []) + ([("o", o.strip().lower())] if o else []):
            parent[find(("s", i))] = find(key)
    members = {}
    for i, *_ in rows:
        members.setdefault(find(("s", i)), []).append(i)
    assert got == {i: (min(m), len(m)) for m in members.values() for i in m}
    labels = df.select(F.col("struct_id").alias("record_id"), "vertical")
    settings_ = [(1, "composition", [0.4, 0.3, 0.3], 7), (2, "Composition", [0.8, 0.1, 0.1], 7), (3, "composition", [0.8, 0.1], 1), (4, "random", [0.4, 0.3, 0.3], 7)]
    settings_ = spark.createDataFrame(settings_, "config_id int, method string, ratios array<double>, seed int")
    out = grouped_splits.stratified_assignment(groups, labels, settings_, ["vertical"]).toPandas()
    assert set(out.config_id) == {1} and len(out) == 2000 and out.record_id.is_unique
    assert (out.groupby("group_id").split_name.nunique() == 1).all()


def test_settings(spark):
    rows = [
        (0, "composition", [0.8, 0.1, 0.1], 1, None), (1, "random", [0.8, 0.1, 0.1], 1, None), (2, None, [0.8, 0.1, 0.1], 1, "method"), (3, "composition", None, 1, "number of ratios"), (4, "composition", [1.0, 0.0, 0.0], 1, "ratio not above 0"),
        (5, "composition", [0.8, 0.3, 0.1], 1, "ratios do not sum to 1"), (6, "composition", [0.8, None, 0.2], 1, "ratio not above 0"), (7, "composition", [0.8, 0.1, 0.1], None, "seed"), (8, "composition", [float("nan"), 0.1, 0.1], 1, "ratio not above 0"),
    ]
    df = spark.createDataFrame(rows, "i int, method string, ratios array<double>, seed int, want string")
    got = df.select("want", grouped_splits.setting_problem(F.col("method"), F.col("ratios"), F.col("seed")).alias("got")).collect()
    assert all(r["want"] == r["got"] for r in got)


# --- mixing -----------------------------------------------------------------------------
@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 40)), min_size=1, max_size=8), st.integers(0, 120))
def test_highest_quotients(parts, seats):
    weights, caps = np.array([w for w, _ in parts], float), np.array([c for _, c in parts])
    got = mixing.sainte_lague(weights, caps, seats)
    plain = np.zeros(len(parts), int)
    for _ in range(seats):
        quotients = [w / (2 * g + 1) if g < c and w > 0 else -1 for w, g, c in zip(weights, plain, caps)]
        if max(quotients) <= 0:
            break
        plain[int(np.argmax(quotients))] += 1
    assert got.sum() == plain.sum() and (got <= caps).all()
    for i in range(len(parts)):  # equal quotients may be given in either order
        for j in range(len(parts)):
            if got[i] > 0 and got[j] < caps[j] and weights[j] > 0:
                assert weights[i] / (2 * got[i] - 1) >= weights[j] / (2 * got[j] + 1) - 1e-9


def test_mix(spark):
    docs = [(i, f"word {i} " * 50, "big" if i < 300 else "small" if i < 330 else None if i < 340 else "other") for i in range(400)] + [(1000, None, "big"), (1001, "", "small")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 3), ("absent", 0.2, 2)], "source string, target_share double, max_repeats int")
    mix = mixing.SourceMix(df, targets, block_tokens=64)
    rows = mix.mixed().collect()
    assert max(r["copies"] for r in rows if r["source"] == "small") <= 3 and all(r["copies"] == 1 for r in rows if r["source"] == "big")
    shares = {r["source"]: r for r in mix.shares().collect()}
    assert shares["small"]["capped"] and shares["absent"]["mixed_tokens"] == 0 and abs(sum(r["actual_share"] for r in shares.values()) - 1) < 1e-9
    again = mixing.SourceMix(df.repartition(7), targets, block_tokens=64).mixed()
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))
    assert mixing.SourceMix(df.limit(0), targets).mixed().count() == 0


def test_a_source_smaller_than_a_block_takes_part(spark):
    df = spark.createDataFrame([(i, f"word {i} " * 200, "big") for i in range(60)] + [(100, "two words", "tiny"), (101, "three more words", "tiny")], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("big", 0.7, 1), ("tiny", 0.3, 2)], "source string, target_share double, max_repeats int")
    shares = {r["source"]: r for r in mixing.SourceMix(df, targets).shares().collect()}
    assert shares["tiny"]["mixed_tokens"] == 2 * shares["tiny"]["available_tokens"] and shares["tiny"]["capped"] and shares["big"]["mixed_tokens"] > 0


# --- subjects ---------------------------------------------------------------------------
NOTICE = "Derived works must carry these same terms. Breach ends the grant at once; the court of the holder prevails over any clause."


def test_votes_by_section_and_notice():
    lexicon, codes = subjects.Lexicon({"violin": "music", "mutex": "software", "court": "law"}), subjects.Codes()
    notices = np.sort(subjects.passages(subjects._cut(NOTICE), codes))
    wrapped = "# " + NOTICE.replace(" once; the", "\n# once; the")
    text = f"{wrapped}\n\nviolinCount = 'mutex held'  # tune the violin\nint x = lastViolin;\n"
    votes = subjects.document_votes(text, "lib/mutex.py", lexicon, notices, codes)
    assert votes["music"][:3] == [2, 1, 0] and votes["software"][2:5] == [1, 1, 1] and "law" not in votes
    assert "law" in subjects.document_votes(text, "", lexicon, notices[:0], codes)
    assert subjects.document_votes("", "", lexicon, notices, codes) == {}


def test_long_words_and_texts_are_treated_like_short_ones():
    lexicon, codes = subjects.Lexicon({"violin": "music"}), subjects.Codes()
    none = np.zeros(0, np.int64)
    blob = "x" + "violinA1" * 30
    for filler in ("", "int a;\n" * 400):
        assert subjects.document_votes(filler + blob, "", lexicon, none, codes) == {}
        assert subjects.document_votes(filler + "f(violin);g(violin);h()", "", lexicon, none, codes)["music"][4] == 2
    assert lexicon.get("a" * 60 + "violin") == "music"


def test_notices_and_shared_words_are_learned(spark):
    """A passage of many different documents is a notice, one of many copies isn't; a word two subjects use belongs to neither."""
    words = {"music": "violin sonata tempo", "law": "statute plaintiff verdict"}
    docs, rated = [], []
    for i in range(80):
        subject = "music" if i % 2 else "law"
        own = words[subject].split()
        body = "\n".join(f"{w}{i}x = {w}  # {own[(k + 1) % 3]} bridge number {chr(97 + i % 26)}{chr(97 + k)}q" for k, w in enumerate(own * 2))
        docs.append((i, f"// {NOTICE}\n\n{body}", "s", "r", "f"))
        rated.append((i, subject))
    copy = "\n".join(f"plain words of a file that was copied often and says nothing new {c}{c}" for c in "abcdefgh")
    docs += [(100 + i, f"{copy} {chr(97 + i)}z", "s", "r", "f") for i in range(20)]
    rated += [(100 + i, "law") for i in range(20)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, source string, repo_name string, file_path string")
    areas = spark.createDataFrame([("music",), ("law",)], "subject string")
    model = subjects.SubjectModel(d, spark.createDataFrame(rated, "doc_id bigint, subject string"), areas)
    notices = model.learn_notices()
    codes = subjects.Codes()
    assert np.isin(subjects.passages(subjects._cut(NOTICE), codes), notices).all() and not np.isin(subjects.passages(subjects._cut(copy), codes), notices).any()
    lexicon = model.learn_lexicon(notices)
    assert lexicon["violin"] == "music" and lexicon["statute"] == "law" and "bridge" not in lexicon and "breach" not in lexicon


def test_subjects_of_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ratings, areas = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("subject_labels", "subject_areas"))
    train = ratings.where("doc_id % 4 <> 0")
    got = subjects.SubjectModel(df, train, areas).assign().toPandas()
    assert not got.duplicated(["doc_id", "subject"]).any() and (got.groupby("doc_id").size() <= 2).all()
    held = ratings.where("doc_id % 4 = 0").toPandas()
    one = held.drop_duplicates(["doc_id", "subject"]).groupby("doc_id").filter(lambda x: len(x) == 1)
    both = one.merge(got, on="doc_id", suffixes=("", "_got"))
    first = both.assign(hit=both.subject == both.subject_got).groupby("doc_id").hit.any()
    assert first.mean() > 0.75
    assert subjects.SubjectModel(df.limit(0), train, areas).assign().count() == 0
    assert subjects.SubjectModel(df, train.limit(0), areas).assign().count() == 0


def test_latent_model_on_no_patterns():
    empty = pd.DataFrame({f: pd.Series(dtype=int) for f in (*subjects.FUNCTIONS, "n")})
    assert 0 < subjects.LatentModel.learn(empty).prior < 1


def test_latent_model_finds_who_is_right():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.4
    body = np.where(truth, rng.integers(60, 140, 20_000), rng.integers(0, 60, 20_000))
    rater = np.where(rng.random(20_000) < 0.2, np.where(rng.random(20_000) < 0.95, truth, ~truth) + 1, 0)
    rows = pd.DataFrame({"body": body, "address": rng.integers(0, 3, 20_000), "source": rng.integers(0, 9, 20_000), "rater": rater, "truth": truth})
    patterns = rows.groupby(list(subjects.FUNCTIONS)).agg(n=("truth", "size")).reset_index()
    model = subjects.LatentModel.learn(patterns)
    logit = np.log(model.prior / (1 - model.prior)) + sum(np.log(t[0] / t[1])[rows[f]] for f, t in model.tables.items())
    assert ((logit > 0) == truth).mean() > 0.97
