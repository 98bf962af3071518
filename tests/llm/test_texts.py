"""Operators on documents against brute force, on rows of every awkward kind."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from joinwright.llm import bpe, idfiles, language, mixing, packing, pretokens, simhash, toxicity
from joinwright.sources import new_folder

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "  ", "\n", " a", "a ", "a  b", "a \n b\n\n c", "it's 's 'S  we'll", "<|endoftext|>",
    "a <|endoftext|> b<|endoftext|>c<|startoftext|>", "　x  y", "中文 测试 é 1²3",
    "\x1c \x1d a", "a\tb \t c", "x" * 3000, "\U0001f642 \U0001f642\U0001f642   z", "a\r\n b",
    "'' ''s \x85 z", "İstanbul ΑΣ ﬁ", "՘ a՘b ₏", "The quick brown fox jumps. " * 400,
]
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, fp long, label string,"
    " graded int, TOKENS int, of string, probability double, length int"
)


def docs(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    full = [(*r, None, 1, "x", 2, 3, "y", 0.5, 4) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def many(spark):
    """Odd texts, a null text, a null id, repeated rows, copies, and a hot source."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice(["an", "the", "or", "st", "li"]) for _ in range(rnd.randint(1, 4)))
    rows = [(i, t, "en", "s0") for i, t in enumerate(ODD)]
    rows += [(100, None, None, None), (None, "some text here", "en", "s1"), (7, ODD[7], "en", "s0")]
    for i in range(200, 260):
        words = [word() for _ in range(rnd.randint(1, 400))]
        rows.append((i, " ".join(words), rnd.choice(["en", "de"]), rnd.choice(["s0", "s1"])))
        if i % 6 == 0:
            near = [*words]
            near[rnd.randrange(len(near))] = "changed"
            rows += [(i + 1000, " ".join(words), "en", "s0"), (i + 2000, " ".join(near), "en", "s0")]
    return docs(spark, rows), rows


def empty(spark):
    return docs(spark, [])


# ------------------------------------------------------------------ token counts


def test_token_counts(spark, many):
    df, rows = many
    library = Tokenizer.from_file(BYTES)
    want = sorted(
        (repr(i), len((t or "").encode()), n, n > 100)
        for i, t, *_ in rows
        for n in [len(library.encode(t or "", add_special_tokens=False).ids)]
    )
    found = bpe.token_counts(df, BYTES, limit=100).collect()
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in found) == want
    assert bpe.token_counts(empty(spark), BYTES).collect() == []


def test_merging_by_heap_is_merging_by_search():
    rnd = random.Random(1)
    ranks = {}
    for rank in range(60):
        pair = (rnd.randrange(12), rnd.randrange(12))
        ranks.setdefault(pair, (rank, 12 + rank % 8 if rank % 3 else rnd.randrange(12)))
    for _ in range(300):
        symbols = [rnd.randrange(12) for _ in range(rnd.randrange(30))]
        left = list(symbols)
        while True:
            at = [(ranks[p][0], i) for i, p in enumerate(zip(left, left[1:])) if p in ranks]
            if not at:
                break
            _, i = min(at)
            left[i : i + 2] = [ranks[(left[i], left[i + 1])][1]]
        assert bpe.merged_length(symbols, ranks) == len(left)


ALPHABET = [
    "'", "'s", "'ll", "'re", "s", "l", "e", " ", "  ", "\n", "\t", "a", "B", "é", "ß", "1", "²", "½", "9", "!", "?",
    "...", "-", "中", "文", "\xa0", "\x85", "\x1c", "\U0001f642", "İ", "Σ", "ς", "e\u0301", "<|endoftext|>",
    "<|startoftext|>", "<|", "ﬁ", "՘", "١", "\u200b", "\ufeff", "ǅ", "\u3000", "ᾳ", "𝟙", "\U000e0041",
]


@pytest.mark.parametrize("slice_bytes", [16, 200, 4 << 20])
@pytest.mark.parametrize("file,words", [(BYTES, False), (WORDS, True)])
def test_ids_are_those_of_the_library(monkeypatch, slice_bytes, file, words):
    """Odd and random texts, cut into runs and parts of several sizes."""
    monkeypatch.setattr(pretokens, "SLICE_BYTES", slice_bytes)
    rnd = random.Random(slice_bytes)
    texts = ODD + ["".join(rnd.choices(ALPHABET, k=rnd.randint(0, 16))) for _ in range(3000)]
    texts += [" ".join(rnd.choices(["word", "it's", "x", "3", "12,5", "é!"], k=200))]
    want = [e.ids for e in Tokenizer.from_file(file).encode_batch(texts, add_special_tokens=False)]
    found = []
    for part in (pa.array(texts), pa.array(["skipped", *texts])[1:]):
        found = []
        for ids, counts in bpe.PieceEncoder(file, words).encode(part):
            found += [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])]
        assert found == want
    if not words:
        assert bpe.counter(file).counts(pa.array(texts)).tolist() == list(map(len, want))


def test_what_is_remembered_is_bounded_and_comes_back():
    asked = []
    kept = pretokens.Remembered(lambda ps: asked.extend(ps) or [p.upper() for p in ps], 3 * 260)
    for _ in range(3):
        for p in b"a", b"b", b"c", b"d", b"x" * 999:
            assert kept.values([p, p]) == [p.upper()] * 2
            assert len(kept.young) <= 3 and len(kept.old) <= 3
    assert [asked.count(bytes([c])) for c in b"abcd"] == [2] * 4  # twice as a pair, once in all
    assert asked.count(b"x" * 999) == 6  # too long to be remembered


# ---------------------------------------------------------------------- id files


def test_id_files_round_trip(spark, many):
    df, rows = many
    folder = new_folder(spark)
    idfiles.write_ids(df, folder, WORDS)
    found = idfiles.crc32(idfiles.read_ids(spark, folder)).orderBy("start").collect()
    library = Tokenizer.from_file(WORDS)
    want, start = [], 0
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in found] == want


def test_id_files_of_nothing(spark):
    folder = new_folder(spark)
    idfiles.write_ids(empty(spark), folder, WORDS)
    assert idfiles.read_ids(spark, folder).collect() == []


@pytest.mark.parametrize("n,longest", [(1, 20), (2, 20), (300, 20), (300, 9), (1000, 10)])
def test_codes_are_prefix_codes_of_least_length(n, longest):
    rnd = np.random.default_rng(n)
    counts = np.sort((rnd.pareto(0.6, n) * 10 + 1).astype(np.int64))
    lengths = idfiles.code_lengths(counts, longest)
    assert lengths.max() <= longest
    if n > 1:
        assert (2.0**-lengths).sum() == 1
    if n == 300 and longest == 20:  # Huffman's own lengths, as the limit does not bind
        import heapq

        heap, total = counts.tolist(), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            total += (both := heapq.heappop(heap) + heapq.heappop(heap))
            heapq.heappush(heap, both)
        assert (lengths * counts).sum() == total
    codec = idfiles.Codec(np.arange(n) * 3, lengths)
    for size in (0, 1, 63, 64, 65, 1000):
        ids = rnd.integers(0, n, size) * 3
        bits, offsets = codec.encode(ids)
        assert (codec.decode(bits, offsets, size) == ids).all()


# ----------------------------------------------------------------------- packing


@pytest.mark.parametrize("chunk", [2000, 20])
def test_packing(spark, many, monkeypatch, chunk):
    df, rows = many
    monkeypatch.setattr(packing, "CHUNK", chunk)
    library, capacity = Tokenizer.from_file(BYTES), 256
    found = packing.pack(df, BYTES, capacity=capacity).toPandas()
    want = []
    for i, t, *_ in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:])):
            want.append((repr(i), piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    ids = found["doc_id"].map(lambda x: repr(None if x != x else int(x)))
    columns = [found[c].tolist() for c in ("piece", "start", "length", "ids_crc32")]
    assert sorted(zip(ids, *columns)) == sorted(want)
    by = found.sort_values(["sequence_id", "offset"]).groupby("sequence_id")["length"]
    ordered = found.sort_values(["sequence_id", "offset"])
    assert (ordered["offset"] == by.cumsum() - ordered["length"]).all()
    assert by.sum().max() <= capacity
    assert by.ngroups <= -(-found["length"].sum() // capacity) * 1.05 + 1
    assert packing.pack(empty(spark), BYTES).collect() == []


def test_evolution_never_gets_worse():
    rnd = random.Random(5)
    lengths = [rnd.randint(1, 700) for _ in range(400)]
    first = packing.evolve(lengths, None, None, 1000, "a")
    later, elite = first, packing.evolve(lengths, None, None, 1000, "b")[0]
    for epoch in range(3):
        later = packing.evolve(lengths, later, elite, 1000, str(epoch))
    assert max(later[0]) <= max(first[0])
    for places in later:
        loads = np.bincount(places, lengths)
        assert loads.max() <= 1000 and loads.min() > 0


# ----------------------------------------------------------------------- SimHash


def plain_fingerprint(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(ids, values, linked):
    """For each row the smallest id of its component, nulls last."""
    label = list(range(len(ids)))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if linked(values[i], values[j]):
                label[top(i)] = top(j)
    roots = [top(i) for i in range(len(ids))]
    least = {}
    for i, r in zip(ids, roots):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [least.get(r) for r in roots]


@pytest.mark.parametrize("chunk", [2048, 4])
def test_near_duplicates(spark, many, monkeypatch, chunk):
    df, rows = many
    monkeypatch.setattr(simhash, "LIST_CHUNK", chunk)
    prints = [plain_fingerprint(t) for _, t, *_ in rows]
    ids = [r[0] for r in rows]
    component = smallest_reachable(ids, prints, lambda a, b: (a ^ b).bit_count() <= 3)
    want = sorted((repr(i), f"{p:016x}", repr(c)) for i, p, c in zip(ids, prints, component))
    found = simhash.hex_fingerprints(simhash.near_duplicates(df)).collect()
    assert sorted((repr(r[0]), r[1], repr(r[2])) for r in found) == want
    kept = simhash.first_of_groups(df)
    assert kept.columns == df.columns
    kept = [r.doc_id for r in kept.collect()]
    assert sorted(map(repr, kept)) == sorted({repr(c) for c in component})


@pytest.mark.parametrize("chunk", [2048, 16])
def test_groups_of_close_fingerprints(spark, monkeypatch, chunk):
    """Chains and clusters of fingerprints, given as they are."""
    monkeypatch.setattr(simhash, "LIST_CHUNK", chunk)
    rnd = random.Random(chunk)
    prints = set()
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(25):
            prints.add(x)
            for b in rnd.sample(range(64), rnd.choice([1, 2, 3, 4, 5])):
                x ^= 1 << b
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    groups = simhash.fingerprint_groups(spark.createDataFrame([(p,) for p in signed], "fp long"))
    found = {r.fp: r.group for r in groups.collect()}
    values = [p % (1 << 64) for p in signed]
    want = smallest_reachable(signed, values, lambda a, b: (a ^ b).bit_count() <= 3)
    pairs = set(zip(want, [found[s] for s in signed]))
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_nothing_has_no_duplicates(spark):
    assert simhash.near_duplicates(empty(spark)).collect() == []
    assert simhash.first_of_groups(empty(spark)).collect() == []


# ------------------------------------------------------------------- language ID


def language_rows():
    rnd = random.Random(9)
    syllables = {"aa": ["ka", "lo", "mi"], "bb": ["str", "ung", "ech"], "cc": ["да", "не", "их"]}
    text = lambda l, n: " ".join("".join(rnd.choices(syllables[l], k=3)) for _ in range(n))
    return text, [(i, text(l, 30), l, "s") for i, l in enumerate(["aa", "bb", "cc"] * 20)]


def test_language_of_documents_and_spans(spark):
    text, rows = language_rows()
    model = language.learn(docs(spark, [*rows, (900, None, "aa", "s"), (901, "ka", None, "s")]))
    assert model.languages == ["aa", "bb", "cc"]
    one, two = text("aa", 70), text("bb", 30)
    asked = [(1, text("aa", 9), "x", None), (2, text("cc", 9), None, None), (3, f"{one}. {two}!", "cc", None),
             (4, None, "aa", "s"), (5, "123 ... \U0001f642", "aa", "s"), (5, "123", "aa", "s"), (None, "", None, None)]
    found = {(r.doc_id, r.lang_pred): r for r in language.identify(docs(spark, asked), model).collect()}
    assert set(found) == {(1, "aa"), (2, "cc"), (3, "aa"), (4, "und"), (5, "und"), (None, "und")}
    spans = [(s.start, s.end, s.lang) for s in found[3, "aa"].spans]
    assert spans == [(0, len(one), "aa"), (len(one) + 2, len(one) + 2 + len(two), "bb")]
    share = len(re.findall(r"\w", one)) / len(re.findall(r"\w", one + two))
    assert found[3, "aa"].score == pytest.approx(share)
    assert all(0 <= r.score <= 1 for r in found.values())
    kept = language.in_a_language(docs(spark, asked), model)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3] and len(kept.columns) == 12


def test_scripts_narrow_the_candidates_first():
    """Unseen words of a script are never of a language that does not write it, and block
    sizes do not show in the scores, which are those of one word after the other."""
    rnd = random.Random(3)
    model = language.LanguageModel(
        ["aa", "ru", "zz"],
        np.log(np.array([rnd.random() for _ in range(3 * language.BUCKETS)]).reshape(-1, 3) * [1, 1e-6, 1]).astype(np.float32),
        np.array([[name == "cyrillic" if l == "ru" else name == "latin" for l in ("aa", "ru", "zz")] for name in language.SCRIPT_NAMES]),
    )
    model.writes[~model.writes.any(axis=1)] = True
    texts = ["слово другое", "word другое и x", "x" * 500 + " я " + "中文"]
    words = language.words_of(texts)
    ends = np.append(words.first[1:], len(words.trigram))
    want = []
    for n, (a, b) in enumerate(zip(words.first, ends)):
        sums = model.weights[words.trigram[a:b]].sum(axis=0)
        candidates = model.writes[words.script[n]]
        want.append([max(s - sums[candidates].max(), -language.MOST) if c else -language.MOST for s, c in zip(sums, candidates)])
    for cells in (1, 7, 100, 1 << 22):
        language.CELLS, before = cells, language.CELLS
        try:
            assert model.word_scores(words) == pytest.approx(np.array(want), abs=2e-2)
        finally:
            language.CELLS = before
    assert [r[0] for r in language.label_texts(model, ["новые слова здесь", "words"])][0] == "ru"


def test_without_a_learned_language_everything_is_unknown(spark):
    model = language.learn(empty(spark))
    found = language.identify(docs(spark, [(1, "words", "aa", "s")]), model).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)]
    assert language.identify(empty(spark), model).collect() == []


def test_viterbi_finds_the_best_path():
    rnd = np.random.default_rng(4)
    for n in (1, 2, 5, 7):
        for spread in (1.0, 6.0):
            scores = -rnd.random((n, 3)) * spread
            cost = lambda p: scores[np.arange(n), p].sum() - 2.0 * (np.diff(p) != 0).sum()  # noqa: B023, E731
            best = max(cost(np.array(p)) for p in np.ndindex(*(3,) * n))
            assert cost(language.viterbi(scores, 2.0)) == pytest.approx(best)


# ---------------------------------------------------------------------- toxicity


def toxic_rows():
    rnd = random.Random(2)
    plain = lambda n: " ".join(rnd.choices("of the and stone river light cloud paper".split(), k=n))
    rows, labels = [], []
    for i in range(240):
        bad = i % 4 == 0
        words = plain(60).split()
        for _ in range(rnd.choice([1, 3, 9]) if bad else 0):
            words.insert(rnd.randrange(60), rnd.choice(["villain", "nasty", "blockheadish"]))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(bad)))
    return plain, rows, labels


def test_severity(spark):
    plain, rows, labels = toxic_rows()
    known = spark.createDataFrame([*labels, (1, 0), (5, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs(spark, rows), known)
    assert {"villain", "nasty", "blockheadish", "block*"} <= set(model.place) and "river" not in model.place
    assert (np.diff(model.thresholds) > 0).all()
    asked = [(1, plain(50), None, None), (2, plain(50) + " nasty", None, None), (3, None, "en", "s"),
             (4, plain(20) + " Villain nasty blockheadless" * 5, None, None), (4, "", None, None)]
    found = sorted(toxicity.severity(docs(spark, asked), model).collect(), key=lambda r: (r.doc_id, r.severity))
    assert [(r.doc_id, r.toxic) for r in found] == [(1, False), (2, True), (3, False), (4, False), (4, True)]
    severity = {(r.doc_id, r.toxic): r.severity for r in found}
    assert severity[1, False] < severity[2, True] < severity[4, True] <= toxicity.GRADES
    kept = toxicity.not_toxic(docs(spark, asked), model)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4] and len(kept.columns) == 12


def test_gradient_of_the_ordinal_loss_reaches_the_optimum():
    """One feature, three grades: the fitted probabilities are the frequencies."""
    rnd = np.random.default_rng(0)
    grades = rnd.choice(3, 4000, p=[0.6, 0.3, 0.1])
    none = np.zeros(0, np.int64)
    _, thresholds = toxicity.fit_ordinal(none, none, np.zeros(0), grades, 1)
    below = 1 / (1 + np.exp(-thresholds))
    assert below == pytest.approx([(grades <= k).mean() for k in (0, 1)], abs=0.01)


def test_without_labels_nothing_is_toxic(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for df in (empty(spark), docs(spark, [(1, "a b", "en", "s")])):
        model = toxicity.learn(df, none)
        assert not any(r.toxic for r in toxicity.severity(df, model).collect())


# ------------------------------------------------------------------------ mixing


def test_raking_meets_the_margins(spark):
    rnd = np.random.default_rng(6)
    rows = [(f"s{a}", f"l{b}", f"t{c}", int(n)) for (a, b, c), n in np.ndenumerate(rnd.integers(1, 99, (4, 3, 2)))]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    shares = {"source": [0.4, 0.3, 0.2, 0.1], "lang": [0.2, 0.3, 0.5], "topic": [0.7, 0.3]}
    targets = {
        d: spark.createDataFrame([(f"{d[0]}{i}", x) for i, x in enumerate(v)], f"{d} string, target double")
        for d, v in shares.items()
    }
    found = mixing.rake(cells, targets, sweeps=12).toPandas()
    weight = found["tokens"] * found["ratio"]
    for d, v in shares.items():
        assert weight.groupby(found[d]).sum().tolist() == pytest.approx(v, abs=1e-6)


def test_raking_ends_when_the_margins_hold(spark, recwarn):
    rows = [("a", "x", "t", 10), ("b", "x", "t", 30), ("b", "y", "t", 60)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")

    def targets(a, x):
        return {
            "source": spark.createDataFrame([("a", a), ("b", 1 - a)], "source string, target double"),
            "lang": spark.createDataFrame([("x", x), ("y", 1 - x)], "lang string, target double"),
            "topic": spark.createDataFrame([("t", 1.0)], "topic string, target double"),
        }

    found = mixing.rake(cells, targets(0.3, 0.5), tolerance=1e-6).toPandas()
    weight = (found["tokens"] * found["ratio"]).groupby(found["lang"]).sum()
    assert weight.tolist() == pytest.approx([0.5, 0.5], abs=1e-5)
    assert not [w for w in recwarn if "off its target" in str(w.message)]
    with pytest.warns(UserWarning, match="off its target"):  # all of a is x, so x is at least as much
        mixing.rake(cells, targets(0.6, 0.5), sweeps=3)


def test_mixing(spark, many):
    df, rows = many
    found = mixing.mix(df).collect()
    assert len(found) == len(rows)
    tokens = sum(r.tokens for r in found)
    assert sum(r.tokens * r.copies for r in found) == pytest.approx(mixing.SHARE * tokens)
    assert all(r.copies > 0 and r.times - 1 < r.copies < r.times + 1 for r in found)
    kept = mixing.sampled(df)
    assert kept.columns == df.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(r.doc_id) for r in found for _ in range(r.times))
    twice = mixing.mix(df, share=2.0).collect()
    assert sum(r.tokens * r.times for r in twice) == pytest.approx(2 * tokens, rel=0.2)
    assert mixing.mix(empty(spark)).collect() == [] == mixing.sampled(empty(spark)).collect()


def test_one_rare_row_does_not_shrink_the_mix(spark):
    """Half the tokens are drawn in their target shares, also beside one row without source and language."""
    rnd = random.Random(5)
    rows = [(i, "some words " * rnd.randint(1, 9), rnd.choice(["en", "de"]), f"s{min(3, i % 8)}") for i in range(4000)]
    shares = []
    for extra in ([], [(4000, "x", None, None)]):
        df = docs(spark, rows + extra)
        drawn = corpus_pipeline.mixed(spark, df, "")
        assert drawn.columns == df.columns
        cells = drawn.select(*(c.alias(n) for n, c in mixing.cell_columns().items())).toPandas()
        every = df.select(*(c.alias(n) for n, c in mixing.cell_columns().items())).toPandas()
        shares.append(cells["tokens"].sum() / every["tokens"].sum())
        for d in ("source", "lang"):
            want = every.groupby(d)["tokens"].sum() ** mixing.TEMPER
            got = cells.groupby(d)["tokens"].sum().reindex(want.index, fill_value=0)
            assert (got / got.sum()).tolist() == pytest.approx((want / want.sum()).tolist(), abs=0.03)
    assert shares == pytest.approx([corpus_pipeline.MIXED] * 2, abs=0.03)
    assert sum(r.doc_id == 4000 for r in drawn.select("doc_id").collect()) >= 1


# ---------------------------------------------------------------------- pipeline


def test_pipeline_stages(spark, tmp_path):
    """Every stage against what its operator decides, then the whole run."""
    plain, rows, labels = toxic_rows()
    rows += [(500, rows[1][1], "en", "s"), (501, None, "en", "s"), (502, "12 34", "en", "s"), (1, rows[1][1], "en", "s")]
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path)
    df.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    at, ids = df, {}
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, folder)
        ids[name] = sorted({r.doc_id for r in at.select("doc_id").collect()})
        if name != "best-fit packing":
            assert at.columns == df.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert 4 <= len(names) <= 5
    assert ids[names[0]] == sorted({r[0] for r in rows} - {501, 502})
    assert ids[names[1]] == [i for i in ids[names[0]] if i >= 240 or i % 4]
    prints = {r[0]: plain_fingerprint(r[1]) for r in rows}
    left = ids[names[1]]
    least = smallest_reachable(left, [prints[i] for i in left], lambda a, b: (a ^ b).bit_count() <= 3)
    assert ids[names[2]] == sorted(set(least)) and 500 not in ids[names[2]]
    assert set(ids[names[3]]) <= set(ids[names[2]]) and ids[names[3]]
    assert ids[names[4]] == ids[names[3]]
    run = corpus_pipeline.run(spark, folder)
    assert sorted({r.doc_id for r in run.collect()}) == ids[names[4]]


def test_pipeline_of_nothing(spark, tmp_path):
    folder = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []
