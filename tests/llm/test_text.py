import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starload.llm import brown, common, decontam, langid, tokencount
from starload.llm.q_langid import fit_on, held_out
from starload.session import read_table

SF = "/root/testdata/sf0.001"

# --- language ----------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    told = langid.identify(spark, docs, fit_on(docs)).where(held_out() & F.length("text").between(40, 10**9))
    got = told.select("lang", "lang_pred", "score", "accepted").collect()
    right = sum(r.lang == r.lang_pred for r in got)
    assert len(got) > 200 and right >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got) and sum(r.accepted for r in got) >= 0.97 * len(got)


def test_labels_and_names_teach_nothing_when_held_out(spark):
    rows = [(i, f"{'der die und' if i % 2 else 'the of and'} {i} wort", "de" if i % 2 else "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    other = docs.withColumn("lang", F.when(held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert fit_on(docs) == fit_on(other)


def test_texts_in_no_learned_language_are_rejected(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10)))
    rows = [(i, " ".join(word() for _ in range(rng.choice([5, 20, 60, 200])))) for i in range(300)]
    noise = langid.identify(spark, spark.createDataFrame(rows, "id INT, text STRING"), fit_on(docs))
    assert noise.where("accepted").count() <= 0.05 * len(rows)
    some = fit_on(docs.where("lang != 'de'"))
    other = langid.identify(spark, docs.where("lang = 'de'"), some)
    assert other.where("accepted").count() <= 0.15 * other.count()


def test_language_of_odd_texts(spark):
    model = langid.Model((("de", b"der die das und nicht"), ("en", b"the and of with is not that")))
    rows = [(1, None), (2, ""), (3, "12 !?\n"), (4, "the and of"), (4, "the and of"), (5, "the and of with " * 9000),
            (6, "ж"), (7, "\U0001f600")]
    docs = spark.createDataFrame([(*r, "q", "r") for r in rows], "id INT, text STRING, score STRING, _told STRING")
    got = langid.identify(spark, docs, model).orderBy("id").collect()
    assert [r.lang_pred for r in got] == ["und"] * 3 + ["en"] * 3 + ["de", "und"]
    assert [r.accepted for r in got] == [False] * 3 + [True] * 3 + [False] * 2
    assert {r._told for r in got} == {"r"} and got[0].score == 0.0
    assert langid.accept(spark, docs, model).columns == docs.columns


def _plainly_told(dictionaries, text):
    """Language, lead and second of a text, by compressing it with each dictionary."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0, None
    flat = " ".join("".join(c if ord(c) > 127 or "a" <= c <= "z" else " " for c in text.lower()).split()).encode()
    sizes = []
    for lang, content in dictionaries:
        found = 0
        for i in range(0, len(flat), langid.PIECE):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            found += len(zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=d, write_content_size=False).compress(
                flat[i : i + langid.PIECE]))
        sizes.append((found, lang))
    (best, lang), (second, other) = sorted(sizes)[:2]
    return lang, (second - best) / second, other


def test_languages_match_a_plain_version(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    odd = [(1000, None), (1001, ""), (1002, "12 34"), (1003, "a"), (1004, "the the the"), (1005, "ÄÖÜ ß " * 900)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    model = fit_on(read_table(spark, "/root/testdata/sf0.001", "documents"))
    got = langid.identify(spark, docs, model).collect()
    assert len(got) == 206 and len(model.dictionaries) > 2
    for r in got:
        lang, lead, other = _plainly_told(model.dictionaries, r.text)
        assert (r.lang_pred, r.score, r.second) == (lang, lead, other)
        assert r.accepted == (lang != "und" and lead >= langid.MIN_MARGIN)


def test_languages_and_counts_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "id BIGINT, text STRING, lang STRING, score INT")
    told = langid.identify(spark, empty, langid.fit(empty))
    assert told.count() == 0 and {"lang_pred", "score", "accepted"} <= set(told.columns)
    counted = tokencount.count_tokens(spark, empty)
    assert counted.count() == 0 and {"n_tokens", "fit_chars", "prefix_tokens"} <= set(counted.columns)


def test_stored_tables_answer_every_budget(spark):
    rows = tokencount.count_tokens(spark, spark.createDataFrame(
        [(1, "Das Öl  ist teuer. <|endoftext|> 😀"), (2, ""), (3, None)], "id BIGINT, text STRING")).collect()
    for r in rows:
        table = tokencount.unpack(r.prefix_tokens)
        text = r.text or ""
        assert [len(BPE.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)] == table.tolist()


def test_models_without_languages_and_with_one(spark):
    rows = [(1, None, "en"), (2, "text", None), (3, "...", "en")]
    none = langid.fit(spark.createDataFrame(rows, "id INT, text STRING, lang STRING"))
    assert none.dictionaries == () and langid.classify(none, "text")[0] == "und"
    assert langid.classify(langid.Model((("en", b""),)), "text") == ("en", 1.0, None)
    many = spark.createDataFrame([(i, "a", f"l{i}") for i in range(langid.MAX_LANGS + 1)], "id INT, text STRING, lang STRING")
    with pytest.raises(ValueError):
        langid.fit(many)


# --- tokens ------------------------------------------------------------------

BPE = Tokenizer.from_file(public_tokenizers.path(tokencount.TOKENIZER))
PARTS = ["\n\n", " ", "  ", "\t", "'re", "'ll", "'", "'s", "don't", "é", "日本", "<|endoftext|>", "<|", "!!", "12",
         " the", "\xa0", "🙂", "\\", "A"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=10).map("".join))
def test_every_prefix_has_its_own_count(text):
    table = tokencount.counter(tokencount.TOKENIZER).table(text)
    want = [len(BPE.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
    assert table.tolist() == want
    assert tokencount.unpack(tokencount.pack(table)).tolist() == want
    for budget in (0, 1, 3):
        assert tokencount.longest_within(table, budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_counts_of_documents(spark):
    docs = read_table(spark, SF, "documents").select("doc_id", "text")
    odd = [(-1, None), (-2, ""), (-3, "a" * 20_000), (-4, " " * 5_000 + "x"), (-5, "<|endoftext|>" * 3), (-5, "x")]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id BIGINT, text STRING")).withColumn("n_tokens", F.lit("c"))
    counted = tokencount.count_tokens(spark, docs, budget=20)
    got = tokencount.prefix_within(spark, counted, 7, "seven").collect()
    assert len(got) == docs.count()
    for r in got:
        text = r.text or ""
        assert r.n_tokens == len(BPE.encode(text, add_special_tokens=False).ids)
        for budget, length in ((20, r.fit_chars), (7, r.seven)):
            assert len(BPE.encode(text[:length], add_special_tokens=False).ids) <= budget


# --- benchmark ---------------------------------------------------------------


def _matches(docs, items):
    """Every alignment of every item, without seeds."""
    split = lambda t: re.findall(r"[一-鿿]|[^\W_一-鿿]+", (t or "").lower())
    best = {}
    for i, text in docs:
        d = split(text)
        for item, other in items:
            t = split(other)
            for shift in range(-len(t) + 1, len(d)) if t else ():
                same = [0 <= k + shift < len(d) and d[k + shift] == w for k, w in enumerate(t)]
                seeds = any(all(k + o < len(t) and same[k + o] for o in mask) for mask in decontam.MASKS for k in range(len(t)))
                run = score = 0
                for s in same:
                    run = max(0, run + (1 if s else -1))
                    score = max(score, run)
                enough = score >= min(decontam.MIN_SCORE, -(-len(t) * decontam.SHORT_SHARE // 1)) or 2 * sum(same) >= len(t)
                if len(t) < decontam.MIN_TOKENS:
                    seeds = enough = all(same)
                if seeds and enough:
                    best[i, item] = max(best.get((i, item), (0, 0)), (sum(same), score))
    return sorted((-1 if i is None else i, item, *x) for (i, item), x in best.items())


def test_decontamination_against_all_alignments(spark, monkeypatch):
    rng = random.Random(3)
    word = lambda: f"{rng.choice('xyz')}{rng.randrange(300)}"
    items = [(k, [word() for _ in range(n)]) for k, n in enumerate([3, 6, 7, 8, 12, 20, 40, 70])]
    docs = []
    for i in range(60):
        t = [word() for _ in range(rng.randrange(0, 60))]
        passage = list(rng.choice(items)[1])
        every = rng.choice([0, 2, 3, 4, 5])
        passage = [w.upper() if not every or k % every else "zzz" for k, w in enumerate(passage)]
        if i % 4:
            t[rng.randrange(len(t) + 1):0] = passage if i % 3 else passage[: len(passage) // 2]
        docs.append((i, " ,".join(t)))
    docs += [docs[9], docs[9], (None, docs[10][1]), (None, None), (70, ""), (71, "same " * 500), (9, "nothing")]
    items = [(k, " ".join(t)) for k, t in items] + [(50, None), (51, ""), (52, "same " * 9), (53, "eine zwei"), (54, "天地玄黄"), (55, "天地玄黄宇宙洪荒日月盈昃")]
    docs += [(80, "Eine, ZWEI und"), (81, "zwei eine"), (82, "說天地玄黄。"), (83, "天地玄宇宙洪荒日月昃"), (84, "天 地玄a黄"),
             (85, "說 天地玄黄宇X洪荒日月盈昃 abc")]
    d = spark.createDataFrame([(*r, 1) for r in docs], "id BIGINT, text STRING, item_id INT").repartition(3)
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id INT, text STRING, id INT")
    want = _matches(docs, items)
    as_rows = lambda df: sorted((-1 if r.id is None else r.id, r.item_id, r.matched, r.score) for r in df.collect())
    assert len(want) > 20 and as_rows(decontam.matches(spark, d, b)) == want
    monkeypatch.setattr(decontam, "MAX_KEYS", 30)  # several scans
    assert as_rows(decontam.matches(spark, d, b)) == want
    empty = d.where("id > 999")
    assert decontam.matches(spark, empty, b).collect() == []
    assert decontam.matches(spark, d, b.where("id > 1")).collect() == []


def test_text_that_repeats_itself_meets_each_alignment_once(spark):
    docs = spark.createDataFrame([(1, "same " * 20_000), (2, "ab cd " * 4000), (3, "same other " * 30)], "id BIGINT, text STRING")
    items = spark.createDataFrame([(1, "same " * 50), (2, "ab cd " * 25)], "item_id INT, text STRING")
    got = {(r.id, r.item_id): (r.matched, r.score) for r in decontam.matches(spark, docs, items).collect()}
    assert got == {(1, 1): (50, 50), (2, 2): (50, 50), (3, 1): (25, 1)}


def test_long_texts_of_many_different_words(spark):
    words = [f"wort{i}" for i in range(30_000)]
    item = words[20_000:20_040]
    item[7] = item[21] = "anders"
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:20_000]))], "id BIGINT, text STRING")
    got = decontam.matches(spark, docs, spark.createDataFrame([(5, " ".join(item))], "item_id INT, text STRING")).collect()
    assert [(r.id, r.item_id, r.matched) for r in got] == [(1, 5, 38)]


def test_many_items_take_one_scan_of_the_documents(spark, written, monkeypatch):
    docs = spark.read.parquet(written([(i, f"a{i} b c d e f g h i{i} j") for i in range(50)], "doc_id BIGINT, text STRING"))
    items = spark.createDataFrame([(i, " ".join(f"t{i}w{k}" for k in range(40))) for i in range(300)], "item_id INT, text STRING")
    plans = []

    def planned(session, df, name):
        if name == "hits":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return common.materialize(session, df, name)

    monkeypatch.setattr(decontam, "materialize", planned)
    decontam.matches(spark, docs, items, id="doc_id")
    assert len(plans) == 1 and sum("FileScan" in x and "text" in x for x in plans[0].splitlines()) == 1


def test_only_contaminated_rows_go(spark, written):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(1, f"a b {item} c"), (1, "clean"), (None, item.upper()), (None, "clean too"), (2, None), (1, "clean")]
    docs = spark.read.parquet(written([(*r, 0) for r in rows], "doc_id BIGINT, text STRING, _row INT"))
    left = decontam.clean(spark, docs, spark.createDataFrame([(1, item)], "item_id INT, text STRING"))
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter([(1, "clean"), (None, "clean too"), (2, None), (1, "clean")])


def test_rows_keep_their_identity_when_files_are_packed_anew(spark, written, monkeypatch):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(i, item if i % 3 == 0 else f"clean {i}") for i in range(200)]
    docs = spark.read.parquet(written(rows, "doc_id BIGINT, text STRING", files=8))
    parts, size = [], "spark.sql.files.maxPartitionBytes"

    def lose_an_executor(session, df, name):
        out = common.materialize(session, df, name)
        if name == "contaminated":
            parts.append(docs.select("text").rdd.getNumPartitions())
            spark.conf.set(size, "4m")
            parts.append(docs.select("doc_id").rdd.getNumPartitions())
        return out

    monkeypatch.setattr(decontam, "materialize", lose_an_executor)
    try:
        left = decontam.clean(spark, docs, spark.createDataFrame([(1, item)], "item_id INT, text STRING")).collect()
    finally:
        spark.conf.unset(size)
    assert parts[0] < parts[1]
    assert sorted(r.doc_id for r in left) == [i for i in range(200) if i % 3]


# --- language model ----------------------------------------------------------


def test_best_class_against_the_likelihood():
    """The gain of a move is the difference of the whole likelihoods."""
    rng = np.random.default_rng(2)
    tokens = np.append(rng.integers(1, 30, 3000), 0)
    classes = np.append(0, rng.integers(1, brown.CLASSES, 29))
    before = np.concatenate(([0], tokens[:-1]))

    def pairs(c):
        m = np.zeros((brown.CLASSES, brown.CLASSES))
        np.add.at(m, (c[before], c[tokens]), 1)
        return m

    def likelihood(c):
        m = pairs(c)
        return brown._f(m).sum() - brown._f(m.sum(axis=0)).sum() - brown._f(m.sum(axis=1)).sum()

    for unit in range(1, 30):
        counts = np.zeros(brown.WIDE, np.int64)
        np.add.at(counts, classes[tokens[before == unit]], 1)
        np.add.at(counts, brown.CLASSES + classes[before[tokens == unit]], 1)
        counts[-1] = ((before == unit) & (tokens == unit)).sum()
        got = brown.best_class(counts, int(classes[unit]), pairs(classes))
        every = [likelihood(np.where(np.arange(30) == unit, c, classes)) for c in range(1, brown.CLASSES)]
        moved = likelihood(np.where(np.arange(30) == unit, got, classes))
        assert moved == pytest.approx(max(every), abs=1e-6)


def test_scores_of_a_small_corpus(spark, monkeypatch):
    monkeypatch.setattr(brown, "BLOCK_TOKENS", 500)
    rng = random.Random(5)
    tongue = [[f"{a}{i}" for i in range(40)] for a in "pq"]
    rows = [(i, i % 5 == 1, " ".join(rng.choice(tongue[i % 2]) for _ in range(rng.randrange(1, 60)))) for i in range(200)]
    rows += [(900, False, None), (901, None, ""), (902, True, " \n"), (None, False, "P1 p1\tP1"), rows[3], rows[3],
             (903, True, "never seen before"), (904, False, "p1 " * 3000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "id BIGINT, held BOOLEAN, text STRING, score INT").repartition(3)
    got = brown.score(spark, docs).collect()
    tokens = [(i, bool(h), [*((t or "").encode().lower().split()), None]) for i, h, t in rows]
    count = Counter(w for _, h, t in tokens if not h for w in t)
    n, v = sum(count.values()), len(count)
    want = defaultdict(list)
    for i, h, t in tokens:
        base = sum(np.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        want[i].append((h, len(t), sum(count[w] > 0 for w in t), n, round(float(base), 6)))
    have = defaultdict(list)
    for r in got:
        have[r.id].append((r.held, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)))
    assert {k: sorted(x) for k, x in have.items()} == {k: sorted(x) for k, x in want.items()}
    held = [r for r in got if r.held and r.n_tokens > 1 and r.id != 903]
    # two vocabularies that never mix are worth one bit a token at most, here less the long text's weight
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.15 * sum(r.n_tokens for r in held)


def test_many_words_choose_as_one_does():
    rng = np.random.default_rng(3)
    for tokens in (rng.integers(0, 90, 4000), np.concatenate((rng.integers(0, 90, 800), np.repeat(7, 60)))):
        classes = np.append(0, rng.integers(1, 9, 89))
        before = np.concatenate(([0], tokens[:-1]))
        pairs = np.zeros((brown.CLASSES, brown.CLASSES))
        np.add.at(pairs, (classes[before], classes[tokens]), 1)
        wide = np.zeros((90, brown.WIDE), np.int64)
        np.add.at(wide, (before, classes[tokens]), 1)
        np.add.at(wide, (tokens, brown.CLASSES + classes[before]), 1)
        np.add.at(wide, (tokens[before == tokens], brown.WIDE - 1), 1)
        want = [brown.best_class(wide[w], int(classes[w]), pairs) for w in range(1, 90)]
        rows, cells = np.nonzero(wide[1:])
        got = brown.best_classes(rows, cells, wide[1:][rows, cells], classes[1:], pairs)
        assert got.tolist() == want and (got != classes[1:]).any()


def test_words_beyond_the_most_frequent_are_clustered(spark, monkeypatch):
    monkeypatch.setattr(brown, "BLOCK_TOKENS", 700)
    monkeypatch.setattr(brown, "WORDS", 4)
    rng = random.Random(5)
    # words of both tongues end alike, so their endings tell nothing
    tongue = [[f"{a}{i}end" for i in range(40)] for a in "pq"]
    rows = [(i, i % 5 == 1, " ".join(rng.choice(tongue[i % 2]) for _ in range(40))) for i in range(300)]
    docs = spark.createDataFrame(rows, "id BIGINT, held BOOLEAN, text STRING").repartition(3)
    held = [r for r in brown.score(spark, docs).collect() if r.held]
    assert len(held) == 60 and all(r.n_known == r.n_tokens for r in held)
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.15 * sum(r.n_tokens for r in held)


def _plain_scores(rows, n_frequent):
    """The whole model in plain Python: ``id`` and score of each text."""
    number = lambda w: int(np.uint64(xxhash.xxh3_64_intdigest(w)).astype(np.int64))
    ending = lambda w: xxhash.xxh32_intdigest(w[-brown.ENDING_BYTES:]) % brown.ENDINGS
    texts = [(i, held, [*text.encode().lower().split(), b" "]) for i, held, text in rows]
    stream = [w for _, held, text in texts if not held for w in text]
    count = Counter(stream)
    ranked = sorted((w for w in count if w != b" "), key=lambda w: (-count[w], number(w)))
    dealt = lambda i: 1 + i % (brown.CLASSES - 1)
    classes = {w: dealt(i if i < n_frequent else ending(w)) for i, w in enumerate(ranked)} | {b" ": 0}
    half = {w: number(w) & 1 for w in ranked} | {
        w: i % 2 for i, w in enumerate(sorted(ranked[:n_frequent], key=number))}

    def pairs():
        m = np.zeros((brown.CLASSES, brown.CLASSES))
        for a, b in zip([b" ", *stream], stream, strict=False):
            m[classes[a], classes[b]] += 1
        return m

    for turn in range(brown.ROUNDS):
        wide = {w: np.zeros(brown.WIDE) for w in count}
        for a, b in zip([b" ", *stream], stream, strict=False):
            wide[a][classes[b]] += 1
            wide[b][brown.CLASSES + classes[a]] += 1
            wide[a][-1] += a == b
        m = pairs()
        classes |= {w: brown.best_class(wide[w], classes[w], m) for w in ranked if half[w] == turn % 2}
    types = np.bincount(list(classes.values()), minlength=brown.CLASSES)
    model = brown.Model(np.array([], np.int64), np.zeros(1, np.int64), pairs(), types, len(stream), len(count))
    tail = defaultdict(Counter)
    for w in ranked[n_frequent:]:
        tail[ending(w)][classes[w]] += 1
    of = lambda w: classes[w] if w in count else (
        min(tail[ending(w)], key=lambda c: (-tail[ending(w)][c], c)) if tail[ending(w)] else dealt(ending(w)))
    after, totals, found = model.transitions(), model.word_totals(), []
    for i, _, text in texts:
        each = [after[of(a), of(b)] + (0 if b == b" " else np.log10((count[b] + 0.5) / totals[of(b)]))
                for a, b in zip([b" ", *text], text, strict=False)]
        found.append((i, round(float(sum(each)), 6)))
    return found


def test_the_model_against_plain_python(spark, monkeypatch):
    monkeypatch.setattr(brown, "BLOCK_TOKENS", 300)
    monkeypatch.setattr(brown, "WORDS", 7)
    rng = random.Random(8)
    words = [[f"{a}{i}" for i in range(60)] for a in ("p", "q", "rs")]
    rows = [(i, i % 5 == 1, " ".join(rng.choice(words[i % 3]) for _ in range(rng.randrange(50)))) for i in range(150)]
    rows += [(200, True, "p1 x1 y1 q2"), (201, False, "q1 q1 q1 p2"), (202, True, "")]
    docs = spark.createDataFrame(rows, "id BIGINT, held BOOLEAN, text STRING").repartition(3)
    got = [(r.id, round(r.score, 6)) for r in brown.score(spark, docs).collect()]
    assert sorted(got) == sorted(_plain_scores(rows, 7))


def test_blocks_are_rows_of_about_a_megabyte(spark):
    """Rows of several megabytes made the heap and the buffers of an executor grow."""
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(999)), lambda x: (F.col("id") * 7 + x) % 5000), " ")
    docs = spark.range(0, 600, 1, 1).select("id", (F.col("id") % 5 == 1).alias("held"), text.cast("binary").alias("text"))
    before = spark.conf.get(size)
    found = brown.blocks(docs).collect()
    assert sum(sum(r.sizes) for r in found) == 600_000 and max(sum(r.sizes) for r in found) <= 250_000
    assert sorted(i for r in found for i in r.ids) == list(range(600))
    with brown._large_rows(spark):
        assert spark.conf.get(size) != before
    assert spark.conf.get(size) == before


def test_probabilities_add_up():
    rng = np.random.default_rng(1)
    pairs = rng.integers(0, 50, (brown.CLASSES, brown.CLASSES)).astype(float)
    model = brown.Model(np.array([], np.int64), np.zeros(1, np.int64), pairs, np.full(brown.CLASSES, 3.0), 1, 1)
    assert np.allclose((10 ** model.transitions()).sum(axis=1), 1)
    # a class with its tokens on three words, and one unseen word
    total = pairs.sum(axis=0)
    words = [np.where(np.arange(3) == 0, total[5] - 2, 1), [0]]
    assert sum((n + 0.5) / model.word_totals()[5] for n in np.concatenate(words)) == pytest.approx(1)


def test_model_of_nothing(spark):
    schema = "id BIGINT, held BOOLEAN, text STRING"
    assert brown.score(spark, spark.createDataFrame([], schema)).collect() == []


def test_crc_is_that_of_the_text(spark):
    got = spark.range(50).select("id", F.crc32(F.col("id").cast("string").cast("binary")).alias("c")).collect()
    assert all(r.c == zlib.crc32(str(r.id).encode()) for r in got)
