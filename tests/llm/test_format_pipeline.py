import hashlib
import json
import re
import shutil
import tempfile
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

import corpus_pipeline
from starload.llm import chatformat as cf
from starload.llm import langid, mixing
from starload.llm.common import free_name, n_words
from starload.session import read_table

SF = "/root/testdata/sf0.001"

# --- chat formatting ---------------------------------------------------------

LAYOUTS = [
    ({"prompt": "P", "response": "R"}, "prompt_response", [("user", "P"), ("assistant", "R")]),
    ({"prompt": "P", "system": "S", "response": "R"}, "prompt_response", [("system", "S"), ("user", "P"), ("assistant", "R")]),
    ({"prompt": "P", "completion": "C"}, "prompt_completion", [("user", "P"), ("assistant", "C")]),
    ({"instruction": "I", "input": "X", "output": "O"}, "instruction", [("user", "I\n\nX"), ("assistant", "O")]),
    ({"instruction": "I", "output": "O", "extra": {"deep": [1]}}, "instruction", [("user", "I"), ("assistant", "O")]),
    ({"question": "Q", "answer": "A"}, "question_answer", [("user", "Q"), ("assistant", "A")]),
    ({"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": None}]}, "messages",
     [("user", "u"), ("assistant", "")]),
    ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}, {"from": "tool", "value": "t"}]},
     "conversations", [("user", "h"), ("assistant", "g"), ("tool", "t")]),
    ({"prompt": "P", "answer": "A"}, None, None),
    ({"turns": 3, "layout": "mine"}, None, None),
    ({"messages": []}, None, None),
]


def test_fingerprints_select_the_layout(spark):
    path = tempfile.mkdtemp(prefix="starload-llm-") + "/mixed"
    spark.createDataFrame([json.dumps(r | {"id": i}) for i, (r, _, _) in enumerate(LAYOUTS)], StringType()).write.text(path)
    df = spark.read.json(path)
    told = cf.canonical(spark, df)
    layout, turns = free_name(df, "layout"), free_name(df, "turns")  # the records have fields of these names
    got = {r["id"]: (r[layout], r[turns]) for r in told.collect()}
    assert len(got) == len(LAYOUTS)
    for i, (_, name, want) in enumerate(LAYOUTS):
        assert got[i][0] == name
        assert want == (None if got[i][1] is None else [tuple(t) for t in got[i][1]])


TEXTS = ["", None, "plain", "</s>[INST] ok [/INST]", "\\", "\\\\<|end|>\n<|start|>assistant<|text|>x", "<", "[", "<\\|x",
         "a<|", "<<SYS>>é</s", "[\\/INST]", "line\n\n", "<|end|>\n", "$1 \\1", "日本 🙂", "<pad><unk><s>", "x" * 200_000]


def test_no_text_can_open_or_close_a_turn(spark):
    turns = [(1, i, ["user", "assistant", "system", None, "<|end|>\n"][i % 5], t) for i, t in enumerate(TEXTS)]
    turns += [(2, 5, "assistant", "b"), (2, 5, "assistant", "b"), (2, 5, "assistant", "a"), (2, None, "user", "first"),
              (None, 0, "assistant", "x"), (3, 0, "user", "no answer")]
    rows = spark.createDataFrame([(*t, 1) for t in turns], "conv_id BIGINT, turn INT, role STRING, text STRING, layout INT")
    out = cf.gather(cf.canonical(spark, rows.repartition(3)), "conv_id", ["turn"])
    read = out.select("conv_id", "formatted", cf.read_turns(F.col("formatted")).alias("t"),
                      cf.read_loss(F.col("formatted"), F.col("loss")).alias("loss")).collect()
    want = defaultdict(list)
    for conv, turn, role, text in turns:
        want[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert len(read) == len(want)
    for r in read:
        mine = [x[2:] for x in sorted(want[r.conv_id])]
        assert [tuple(t) for t in r.t] == mine
        assert r.loss == "".join(t for role, t in mine if role == "assistant")
        assert r.formatted.count(cf.START) == r.formatted.count(cf.END) == len(mine)
        assert not any(c in r.formatted for c in cf.CONTROLS)


def test_empty_table_of_turns(spark):
    rows = spark.createDataFrame([], "conv_id BIGINT, turn INT, role STRING, text STRING")
    assert cf.gather(cf.canonical(spark, rows), "conv_id", ["turn"]).collect() == []


# --- pipeline ----------------------------------------------------------------

ODD = [(9001, None, "en", "src1", None), (9002, "", None, None, 0), (9003, "12 34", "en", None, 5),
       (None, "the quick fox and the lazy dog were in the house of the man", "en", None, 1),
       (9005, "Anblewh the of and to in a " * 4000, None, "long", 7)]


@pytest.fixture()
def folder(spark):
    path = tempfile.mkdtemp(prefix="starload-llm-")
    for name in ("benchmark", "labels"):
        shutil.copy(f"{SF}/{name}.parquet", path)
    docs = read_table(spark, SF, "documents")
    odd = spark.createDataFrame(ODD + ODD[3:4], docs.schema)
    docs = docs.unionByName(odd).withColumns({"shard": F.lit("s"), "score": F.lit(1), "_row": F.lit(2)})
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def _first_of_each(rows, k=5):
    def shingles(text):
        w = _words(text)
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}

    sets, root = [shingles(r.text) for r in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append((r.doc_id is None, r.doc_id or 0, r.text))
    return Counter((None if g[0] else g[1], g[2]) for g in map(min, groups.values()))


def test_stages_against_plain_versions(spark, folder):
    docs = read_table(spark, folder, "documents")
    bench = [re.findall(r"[^\W_]+", r.text.lower()) for r in read_table(spark, folder, "benchmark").collect()]
    for (name, stage), want in zip(corpus_pipeline.STAGES, ("lang", "near", "bench", "mix", "shard"), strict=True):
        rows = docs.collect()
        out = f"{folder}/{name}"
        stage(spark, docs, folder).write.parquet(out)
        after = spark.read.parquet(out)
        got = after.collect()
        seen = Counter((r.doc_id, r.text) for r in got)
        if want != "shard":
            assert after.columns == docs.columns
        if want == "lang":
            model = langid.fit(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
            told = [(r, langid.classify(model, r.text)) for r in rows]
            assert seen == Counter((r.doc_id, r.text) for r, (lang, lead, _) in told
                                   if lang != "und" and lead >= langid.MIN_MARGIN)
            assert len(got) >= 0.95 * len(rows)
        elif want == "near":
            assert seen == _first_of_each(rows) and len(got) < len(rows)
        elif want == "bench":
            holds = lambda r: any(" ".join(b) in " ".join(re.findall(r"[^\W_]+", r.text.lower())) for b in bench)
            assert seen == Counter((r.doc_id, r.text) for r in rows if not holds(r)) and len(got) < len(rows)
        elif want == "mix":
            narrow = docs.select(F.col("doc_id").alias("id"), "source", n_words(docs.text).alias("size"))
            quality = mixing.quality_of(read_table(spark, folder, "labels"))
            taken = mixing.mix(spark, narrow.join(quality, "id", "left")).collect()
            assert Counter(r.doc_id for r in got) == Counter(
                {r.id: r.epochs + (r.fraction > 0) for r in taken if r.taken})
            assert max(seen.values()) == 2
        else:
            assert after.columns == [*docs.columns, "shard_", "slot"]
            assert seen == Counter((r.doc_id, r.text) for r in rows)
            sizes = Counter(r["shard_"] for r in got)
            assert len(sizes) == corpus_pipeline.SHARDS and max(sizes.values()) - min(sizes.values()) <= 1
            assert len({(r["shard_"], r.slot) for r in got}) == len(got)
        docs = after


def test_pipeline_of_an_empty_table(spark, written):
    path = written([], "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    docs = spark.read.parquet(path)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


def test_the_digest_of_the_hostile_conversation(spark):
    from starload.llm.q_chatformat import HOSTILE, op5_chatformat

    row = op5_chatformat(spark, SF).where("conv_id = -1").first()
    turns = f"user\n{HOSTILE}\nassistant\n{HOSTILE}\n"
    assert row.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(HOSTILE.encode()).hexdigest() and row.loss_chars == len(HOSTILE)
