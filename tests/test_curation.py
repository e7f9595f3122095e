import math

import pytest
from pyspark.sql import functions as F

from quern.operators import chunking, citations, decontam, dedup, gates, ledger, manifest, reports, splits
from quern.sources import config
from quern.sources.tables import discover, key_values, process_metrics, read_markers, read_subset, tree_sample

YAML = """model:
  repo: a/b
  revision: {pin}
data: {{think_open: '<think>', think_close: '</think>'}}
lora: {{r: 32, alpha: 32, dropout: 0.0, target_modules: '.*proj'}}
train:
  seed: 3407
  lr: 0.0002
  warmup_ratio: 0.03
  weight_decay: 0.01
  optim: x
  lr_scheduler_type: cosine
  smoke: {{max_seq_length: 8192, per_device_train_batch_size: 1, gradient_accumulation_steps: 2, max_steps: 60, save_steps: 20, dataset: d}}
hub: {{checkpoint_repo: null}}
"""


def test_config():
    s = config.parse(YAML.format(pin="abc"))
    assert s.lora.target_modules == ".*proj" and config.parse(config.dump(s)) == s
    with pytest.raises(ValueError, match="revision"):
        config.parse(YAML.format(pin="null"))
    assert config.parse(YAML.format(pin="null"), allow_unpinned=True).model.revision is None
    with pytest.raises(TypeError):
        config.parse(YAML.format(pin="abc").replace("repo: a/b", "repo: a/b\n  typo: 1"))
    with pytest.raises(KeyError):
        config.parse(YAML.format(pin="abc").replace("hub:", "hob:"))
    run = s.train.smoke
    assert config.overridden(run, max_steps=4, save_steps=None) == config.overridden(run, max_steps=4) and run.max_steps == 60
    assert config.overridden(run, max_steps=0).max_steps == 0
    args = config.trainer_args(s, run, "out")
    assert args["warmup_steps"] == 2 and args["fp16"] and not args["bf16"] and "hub_model_id" not in args
    text = config.pinned(YAML.format(pin="null"), "sha1")
    assert config.parse(text).model.revision == "sha1" and config.pinned(text, "sha1") == text
    assert config.pinned("a:\n  revision:\n  b: 1\n", "x") == "a:\n  revision: x\n  b: 1\n"
    with pytest.raises(ValueError):
        config.pinned("a: 1", "x")
    assert config.rehome("org/name", "me") == "me/name"
    assert run.max_seq_length * run.per_device_train_batch_size * run.gradient_accumulation_steps * 2 == 32768


def test_manifest(spark):
    one = spark.range(1)
    got = one.select(
        manifest.capable(F.lit(6), F.lit(0)).alias("a"), manifest.capable(F.lit(7), F.lit(5)).alias("b"), manifest.visible(F.lit(2), F.lit(1)).alias("c"),
        manifest.visible(F.lit(1), F.lit(1)).alias("d"), manifest.visible(F.lit(2), F.lit(2)).alias("e"), manifest.capability(F.lit("7.5")).alias("f"),
        manifest.capability(F.lit("x")).alias("g"), manifest.warmup_steps(F.lit(0.03), F.lit(60)).alias("h"), manifest.targeted(F.lit("a.q_proj"), r".*(q|k)_proj").alias("i"),
        manifest.tokens_per_step(F.lit(8192), F.lit(1), F.lit(2), F.lit(2)).alias("j"), manifest.precision_flags(F.lit(False)).alias("k"),
    ).first()
    assert got[:5] == (False, True, False, True, True) and got.f == (7, 5) and got.g is None and got.h == 2 and got.i and got.j == 32768 and got.k == (True, False)
    with pytest.raises(Exception, match="revision"):
        manifest.require_pin(spark.createDataFrame([("a", None)], "repo string, revision string")).collect()
    modes = spark.createDataFrame([("SMOKE", ["--max-steps", "60"])], "mode string, args array<string>")
    asked = lambda m: manifest.mode_args(spark.createDataFrame([(m,)], "mode string"), modes)
    assert asked("SMOKE").first().args == ["--max-steps", "60"]
    with pytest.raises(Exception, match="unknown mode"):
        asked("NOPE").collect()
    names = spark.createDataFrame([("m.Vision.q.lora_A.w",), ("m.text.q.lora_A.w",), ("m.vision.q.w",)], "name string")
    assert [r.module for r in manifest.forbidden_modules(names).collect()] == ["m.Vision.q"]


def test_discovery(spark, tmp_path):
    for d, sha in (("a/x", "s1"), ("b", "s2"), ("c/d/e", "s1")):
        (tmp_path / d).mkdir(parents=True)
        (tmp_path / d / "REVISION.txt").write_text(f"org/m {sha}\n")
    found = [(r.depth, r.path.split(str(tmp_path))[1]) for r in discover(spark, f"file://{tmp_path}", "REVISION.txt").collect()]
    assert found == [(1, "/b/REVISION.txt"), (2, "/a/x/REVISION.txt")]
    assert len(tree_sample(spark, f"file://{tmp_path}", 2)) == 2 and tree_sample(spark, f"file://{tmp_path}/none") == []
    assert read_subset(spark, f"file://{tmp_path}", "REV*").count() == 3
    markers = read_markers(spark, f"file://{tmp_path}/*/*/REVISION.txt").unionAll(read_markers(spark, f"file://{tmp_path}/*/REVISION.txt"))
    models = spark.createDataFrame([("org/m", "s1"), ("org/m", "s9")], "repo string, revision string")
    got = {r.source.split("/")[-1]: r.revision for r in manifest.resolve_sources(models, markers).collect()}
    assert got == {"x": None, "m": "s9"}
    lines = spark.createDataFrame([("Tesla T4, 15360 MiB",)], "value string")
    assert process_metrics(lines).first() == ("Tesla T4", 15360)
    assert [r.value for r in key_values(spark.createDataFrame([(0.5, None)], "train_loss double, x int")).collect()] == ["train_loss=0.5"]


def test_gates_and_judges(spark):
    d = spark.createDataFrame([(1, "word " * 25 + "end.", "en"), (2, "short.", "fr"), (3, None, None)], "doc_id int, text string, lang string")
    got = {r.doc_id: r.reasons for r in gates.with_reasons(d, gates.rule_floors()).collect()}
    assert got == {1: [], 2: ["length", "language"], 3: ["length", "language", "structure"]}
    assert gates.passing(gates.with_reasons(d, gates.rule_floors())).count() == 1
    s = spark.createDataFrame([(1, "a", "x", "g", "c", 4), (1, "b", "y", "g", "c", 5), (2, "a", "x", "g", "c", 5), (3, "a", "x", "g", "c", 3), (3, "b", "y", "g", "c", 5)], "example_id int, judge string, judge_family string, generator_family string, criterion string, score int")
    assert {r.example_id: r.passed for r in gates.judge_pass(s).collect()} == {1: True, 2: False, 3: False}
    assert {(r.example_id, r.judge_a, r.judge_b) for r in gates.judge_pairs(s).collect()} == {(1, "a", "b"), (3, "a", "b")}


def test_chunks(spark):
    d = spark.createDataFrame([(1, "a b\n\nc d e\nf"), (2, ""), (3, None)], "doc_id long, text string")
    assert [(r.doc_id, r.chunk_ix, r.chunk_text) for r in chunking.chunk_words(d, 4).orderBy("chunk_ix").collect()] == [(1, 0, "a b c d"), (1, 1, "e f")]
    got = [(r.doc_id, r.chunk_ix, r.chunk_text, r.n_tokens) for r in chunking.chunk_paragraphs(d, 3).orderBy("chunk_ix").collect()]
    assert got == [(1, 0, "a b", 2), (1, 1, "c d e", 3), (1, 2, "f", 1)]


def test_dedup_and_decontamination(spark):
    t = " ".join(f"w{i}" for i in range(60))
    d = spark.createDataFrame([(1, t), (2, t + " more"), (3, "other words here"), (4, t), (5, None)], "doc_id long, text string")
    assert {(r.doc_id, r.n_copies) for r in dedup.drop_copies(d).collect()} == {(1, 2), (2, 1), (3, 1), (5, 1)}
    signed = d.select("doc_id", dedup.signature(F.col("text")).alias("sig"))
    pairs = {(r.a, r.b) for r in dedup.verified(dedup.candidates(signed), d).collect()}
    assert (1, 4) in pairs and all(a in (1, 2) and b in (2, 4) for a, b in pairs)
    items = spark.createDataFrame([(7, " ".join(f"w{i}" for i in range(20, 33)))], "item_id long, text string")
    assert {r.doc_id: r.n_shared for r in decontam.contaminated(d, items).collect()} == {1: 1, 2: 1, 4: 1}
    assert decontam.contaminated(d, items, quotable=items).count() == 0
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0]), (4, [0.0, 0.0])], "vec_id long, embedding array<double>")
    assert {r.vec_id: r.n_near for r in decontam.similarity_screen(v, v.filter("vec_id = 1"), 0.9).collect()} == {2: 1}


def test_pairs_that_cannot_be_near_are_passed_over_before_sets_are_fetched(spark, monkeypatch):
    """Sets that share bands but differ in size or in words leave no candidate pair; near ones of any size stay."""
    w = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    texts = [w(0, 1500), w(0, 2100), w(0, 1450) + " x y", w(0, 700) + " " + w(3000, 3800), w(0, 30), w(0, 31), w(0, 30) + " W1", None, " \t\x0b"]
    d = spark.createDataFrame([*enumerate(texts), (None, w(0, 30)), (4, w(9000, 9030))], "doc_id long, text string")
    seen, settled = {}, dedup.settled
    monkeypatch.setattr(dedup, "settled", lambda df, label: seen.setdefault(label, settled(df, label)))
    got = {(r.a, r.b): r.jaccard for r in dedup.near_firsts(d).collect()}
    sets = {i: set(t.lower().split()) for i, t in enumerate(texts) if t and t.split()}
    near = {(a, b): j for a in sets for b in sets if a < b and (j := len(sets[a] & sets[b]) / len(sets[a] | sets[b])) >= 0.8}
    assert {(0, 2), (4, 5)} <= got.keys() <= near.keys() and all(abs(j - near[p]) < 1e-9 for p, j in got.items()) and got[4, 6] == 1.0
    assert {(r.a, r.b) for r in dedup.candidates(d.select("doc_id", dedup.signature(F.col("text")).alias("sig"))).collect()} > got.keys()
    assert seen["pairs"].count() == 2


def test_candidates_by_brute_force(spark):
    """All pairs that share a band, once each: with keys in blocks, and with an id on several rows."""
    rows = [(i % 90, [f"{(i * p) % m:08x}" for p, m in ((7, 3), (1, 2), (5, 11), (3, 13), (1, 40), (1, 7), (1, 97), (1, 89))]) for i in range(100)]
    want = {(min(a, b), max(a, b)) for a, s in rows for b, t in rows if a != b and any(s[k : k + 2] == t[k : k + 2] for k in (0, 2, 4, 6))}
    for some in (rows, rows[:90]):
        d = spark.createDataFrame(some, "doc_id long, sig array<string>")
        ids = {i for i, _ in some}
        own = want if some is rows else {(a, b) for a, s in some for b, t in some if a < b and any(s[k : k + 2] == t[k : k + 2] for k in (0, 2, 4, 6))}
        for block in (4, 4096):
            out = dedup.candidates(d, block_rows=block)
            assert sorted(map(tuple, out.collect())) == sorted(own) and len(ids) == 90
    plan = dedup.candidates(spark.createDataFrame(rows[:90], "doc_id long, sig array<string>"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def test_calibrated_threshold(spark):
    rows = [([1.0, 0.0], [math.cos(k / 100), math.sin(k / 100)]) for k in range(1, 101)]
    rest = [(None, [1.0]), ([1.0, None], [1.0, 0.0]), ([1.0], [1.0, 0.0]), ([math.nan, 1.0], [1.0, 1.0]), ([math.inf, 1.0], [1.0, 1.0])]
    apart = spark.createDataFrame(rows + rest, "a array<double>, b array<double>")
    for rate in (0.0, 0.05, 0.5, 0.99):
        t = decontam.calibrated_threshold(apart, "a", "b", rate)
        reach = lambda x: sum(math.cos(k / 100) >= x for k in range(1, 101))
        assert reach(t) <= 100 * rate < reach(t - 1e-4)
    zeros = spark.createDataFrame([([0.0], [1.0])] * 3, apart.schema)
    assert decontam.calibrated_threshold(zeros, "a", "b", 0.1) == 1e-4
    for bad, rate in ((apart.limit(0), 0.1), (spark.createDataFrame(rest, apart.schema), 0.1), (apart, 1.0)):
        with pytest.raises(ValueError):
            decontam.calibrated_threshold(bad, "a", "b", rate)


def test_citations(spark):
    c = spark.createDataFrame([(1, "IPC 302"), (1, "CrPC 41"), (2, "IPC 3O2"), (3, "XYZ 1"), (3, None)], "example_id int, citation string")
    corpus = spark.createDataFrame([("IPC 302",), ("CrPC 41",)], "citation string")
    got = {r.example_id: tuple(r)[1:] for r in citations.verify(c, corpus).collect()}
    assert got == {1: (2, 2, 0, True), 2: (1, 0, 1, True), 3: (1, 0, 0, False)}
    one = citations.ungrounded(spark.createDataFrame([(["IPC 1", "BNS 2"], ["IPC 1"])], "cited array<string>, grounded array<string>")).first()
    assert (one.extra, one.cross_code) == (["BNS 2"], ["BNS"])


def test_splits_are_stable_under_repartition(spark):
    d = spark.range(100).select(F.col("id").alias("doc_id"), (F.col("id") % 3).alias("s"), F.col("id").alias("day"))
    a, b = (sorted(r.doc_id for r in splits.holdout(x, "s").filter("held_out").collect()) for x in (d, d.repartition(7)))
    assert a == b and len(a) == 9
    assert sorted(r.doc_id for r in splits.holdout(d, "s", newest_first="day").filter("held_out").collect()) == list(range(91, 100))
    assert splits.mix(d, {0: 5, 1: 2}, "s").count() == 7
    assert splits.union_streams(d, d.drop("day"), d.drop("s")).count() == 300
    assert {r.s: round(r.share, 2) for r in splits.shares(d, "s").collect()} == {0: 0.34, 1: 0.33, 2: 0.33}


def test_ranks_keep_null_ids_groups_and_dates(spark):
    d = spark.createDataFrame([(1, None, None), (None, "a", 3), (2, "a", None), (3, "a", 5), (None, None, 1)], "doc_id long, s string, day int")
    assert splits.holdout(d, "s").count() == 5 and splits.holdout(d, "s", newest_first="day").count() == 5
    got = {(r.doc_id, r.s, r.held_out) for r in splits.holdout(d, "s", 0.34, newest_first="day").collect()}
    assert (3, "a", True) in got or sum(h for _, s, h in got if s == "a") == 1


def test_ledger(spark):
    e = spark.createDataFrame([(1, "c1", "todo", 5), (2, "c1", "done", 6), (3, "c2", "todo", 5)], "event_id int, chunk string, status string, n int").withColumn("ts", F.to_timestamp(F.concat(F.lit("2024-01-01 00:00:0"), "event_id")))
    assert {(r.chunk, r.status) for r in ledger.latest(e, ["chunk"]).collect()} == {("c1", "done"), ("c2", "todo")}
    assert [r.chunk for r in ledger.outstanding(e.select("chunk").distinct(), e, ["chunk"]).collect()] == ["c2"]
    assert [r.admitted for r in ledger.admit(e.withColumn("p", F.lit(1)), 11, ["p"], "n").orderBy("event_id").collect()] == [True, True, False]
    assert [r.b for r in spark.range(10).select(ledger.backoff(F.col("id"), 1.0, 60.0).alias("b")).collect()][:7] == [1, 2, 4, 8, 16, 32, 60]


def test_reports(spark):
    runs = spark.createDataFrame([(60, 1, 2, 8192, 100.0, False, 2), (60, 1, 2, 8192, 100.0, True, 2)], "steps int, batch int, accum int, seq int, runtime_s double, resumed boolean, world_size int")
    a, b = reports.throughput(runs).collect()
    assert a.tok_per_sec == 2 * a.tok_per_sec_rank == 2 * 60 * 2 * 8192 / 100 and b.tok_per_sec is None
    peaks = spark.createDataFrame([("r", 0, 12_980_000_000), ("r", 1, 13_180_000_000), ("r", 1, 5)], "run_id string, device int, peak_bytes long")
    assert reports.device_peaks(peaks).first() == ("r", 13.18, [12.98, 13.18])
    results = lambda t, g: spark.createDataFrame([("target", 50.0, 50.0 + t), ("mmlu", 60.0, 60.0 + g)], "instrument string, baseline double, adapter double")
    assert [reports.decide(results(*x)).first().decision for x in ((3, -1), (1, 0), (5, -3), (-1, 0))] == ["scale", "confirm", "stop", "stop"]
    assert reports.win_rate(spark.createDataFrame([(1, 1.0), (1, 0.0), (2, 1.0)], "item_id int, win double")).first() == (2, 0.75, True)
    assert spark.range(1).select(reports.dataset_size(F.lit(24), F.lit(438), F.lit(2500))).first()[0] == 24 * 438 * 3600 // 2500


def test_injected_sources_and_secrets(spark):
    from quern.sources.injected import rows_data_source, secret

    spark.dataSource.register(rows_data_source("quern_rows", "i int, t string", lambda part: [(part * 10 + k, f"r{k}") for k in range(2)], 3))
    assert sorted(r.i for r in spark.read.format("quern_rows").load().collect()) == [0, 1, 10, 11, 20, 21]

    def broken():
        raise OSError("no file")

    assert secret([broken, lambda: " ", lambda: " key \n"]) == "key" and secret([broken], required=False) is None
    with pytest.raises(LookupError):
        secret([broken])


def test_assembly(spark):
    from quern.operators import assembly

    d = spark.createDataFrame([(1, "c1", "a"), (2, "c9", " b ")], "doc_id long, chunk_id string, text string")
    src = spark.createDataFrame([("c1", "law", "mit")], "chunk_id string, source string, license string")
    assert [(r.doc_id, r.provenance.license) for r in assembly.with_provenance(d, src).collect()] == [(1, "mit")]
    assert [r.doc_id for r in assembly.not_verbatim(d, spark.createDataFrame([("b",)], "text string")).collect()] == [1]
    assert [r.doc_id for r in assembly.excluding(d, d.filter("doc_id = 1"), "doc_id").collect()] == [2]
    assert assembly.share_reached(d, F.col("text") == "a", 0.8).first() == (0.5, False)
    assert assembly.sampled_rate(d, F.col("text") == "a", 200).first() == (2, 0.5)


def test_assembly_fetches_the_sets_of_near_copies_alone(spark, monkeypatch):
    from quern.operators import assembly

    w = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    texts = [w(0, 1500), w(0, 2100), w(0, 1450) + " x y", w(0, 700) + " " + w(3000, 3800), w(0, 1500).upper(), None]
    d = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    seen, settled = {}, dedup.settled
    monkeypatch.setattr(dedup, "settled", lambda df, label: seen.setdefault(label, settled(df, label)))
    assert sorted(r.doc_id for r in assembly.without_near_copies(d).collect()) == [0, 1, 3, 5]
    assert seen["sets"].count() == 2


def test_pluggable_judge(spark):
    def scorer(batch):
        rows = [(i, c, 5 if "good" in t else 1) for i, t in zip(batch["example_id"], batch["text"]) for c in ("clarity", "truth")]
        return __import__("pandas").DataFrame(rows, columns=["example_id", "criterion", "score"])

    e = spark.createDataFrame([(1, "good"), (2, "bad")], "example_id int, text string")
    scores = gates.score_with(e, "a", "x", scorer).unionByName(gates.score_with(e, "b", "y", scorer))
    assert {r.example_id: r.passed for r in gates.judge_pass(scores).collect()} == {1: True, 2: False}
