"""Queries of the fine-tuning data operators over the driver's tables, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import assembly, chat, chunking, citations, decontam, dedup, folds, gates, guard, ledger, manifest, reports, splits, turns
from ..sources.shared import shared_path
from ..sources.tables import CONVERSATION, clean_pages, read_jsonl, spread, write_jsonl
from .relational import table

BT, ET, BS, ES = turns.BEGIN_THOUGHT, turns.END_THOUGHT, turns.BEGIN_SOLUTION, turns.END_SOLUTION


def marked_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the marked source: two of three conversations get the markers round their first two assistant texts."""
    c = table(spark, sf_dir, "conversations")
    own = F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", F.struct("turn", "text"))))
    second = c.groupBy("conv_id").agg(F.get(own, F.lit(1))["text"].alias("second"))
    first = turns.first_turns(c).join(second, "conv_id")
    a, s = F.coalesce("assistant", F.lit("")), F.coalesce("second", F.lit(""))
    whole = F.concat(F.lit(BT), a, F.lit(f"{ET}\n{BS}"), s, F.lit(ES))
    return first.withColumn("assistant", F.when(F.col("conv_id") % 3 != 0, whole).otherwise(a)).drop("second")


def smoke_sft(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = turns.build_examples(marked_turns(spark, sf_dir), "conv_id", 1000, "<think>", "</think>")
    return made.select("conv_id", F.col("messages")[0]["content"].alias("prompt"), F.col("messages")[1]["content"].alias("response"))


def smoke_skip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.build_counts(marked_turns(spark, sf_dir), "conv_id", 20)


def chatml_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render_long(table(spark, sf_dir, "conversations")).select("conv_id", "text")


def mask_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.mask_coverage(chat.render_long(table(spark, sf_dir, "conversations"))).select("conv_id", "n_chars", "trained_chars", "n_responses")


def probe_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "conversations").filter("role <> 'system'").groupBy("conv_id").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"))
    shards = folds.shards_for(t.count())
    groups = folds.greedy_groups(t.withColumn("shard", F.col("conv_id") % shards), "shard", "conv_id", "chars", folds.least_chars(1000))
    return groups.groupBy("shard", "group_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("chars").alias("chars"), F.min("conv_id").alias("first_conv"))


def pack_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", (F.col("doc_id") % folds.shards_for(docs.count())).alias("shard"), F.ceil(F.length("text") / 4).alias("tokens"))
    return folds.pack(rows, "shard", "doc_id", "tokens", 8192)


def nonfinite_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    step = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    logs = e.select(F.col("user_id").alias("run_id"), step.cast("long").alias("step"), F.when(F.col("event_type") == "error", "nan").when(F.col("event_type") == "view", "n/a").otherwise(F.col("value").cast("string")).alias("grad_norm"))
    return guard.first_streaks(logs, grace=2, window=2)


def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.length_histogram(table(spark, sf_dir, "documents"), F.length("text"), "lang").withColumn("longest", F.col("longest").cast("long"))


def drop_overlength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.drop_over_length(table(spark, sf_dir, "documents"), F.ceil(F.length("text") / 4), 2048).select("doc_id")


def rule_floors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.with_reasons(table(spark, sf_dir, "documents"), gates.rule_floors()).select("doc_id", F.array_join("reasons", ",").alias("reasons"))


def rule_survival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.reason_counts(gates.with_reasons(table(spark, sf_dir, "documents"), gates.rule_floors()))


def lang_toxic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, lab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return d.filter("lang = 'en'").join(lab.filter("toxic = 1").select("doc_id"), "doc_id", "left_anti").select("doc_id", "source")


def license_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = spark.createDataFrame([("apache", True), ("mit", True), ("gpl", False), ("reserved", False)], "license string, allowed boolean")
    t = F.lower("text")
    found = F.when(t.contains("apache license"), "apache").when(t.contains("mit license"), "mit").when(t.contains("gnu general public license"), "gpl").when(t.contains("all rights reserved"), "reserved")
    return gates.licensed(table(spark, sf_dir, "documents").withColumn("license", found), policy).select("doc_id", "license")


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.drop_copies(table(spark, sf_dir, "documents")).select("doc_id", "n_copies")


def _signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    dedup.small_batches(spark)
    return spread(table(spark, sf_dir, "documents")).select("doc_id", dedup.signature(F.col("text")).alias("sig"))


def minhash_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signed(spark, sf_dir).select("doc_id", F.array_join("sig", "").alias("sig"))


def lsh_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate pairs of the first documents of equal signatures; the others are candidates of the same partners."""
    firsts = _signed(spark, sf_dir).filter("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("doc_id"))
    return dedup.candidates(firsts)


def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with equal word sets as pairs with their first one, and all near pairs of these first ones."""
    found = dedup.near_firsts(spread(table(spark, sf_dir, "documents")))
    return found.select("a", "b", F.round("jaccard", 6).alias("jaccard"))


def decontam_13gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def embed_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    return decontam.similarity_screen(v, v.filter("label = 0"), 0.35)


def embed_calibrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors near those of label 0, at the cosine that 1 % of the neighbours by id with different labels reach."""
    v = table(spark, sf_dir, "embeddings")
    after = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"), F.col("label").alias("other_label"))
    apart = v.join(after, "vec_id").filter("label <> other_label")
    least = decontam.calibrated_threshold(apart, "embedding", "other", 0.01)
    return decontam.similarity_screen(v, v.filter("label = 0"), least).withColumn("threshold", F.lit(least))


def chunk_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunk_words(spread(table(spark, sf_dir, "documents"))).select("doc_id", "chunk_ix", F.md5("chunk_text").alias("chunk_hash"), "n_words")


def chunk_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunk_paragraphs(spread(table(spark, sf_dir, "documents")), 512).select("doc_id", "chunk_ix", "chunk_id", "n_tokens")


def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.holdout(table(spark, sf_dir, "documents"), "source", 0.1).filter("held_out").select("doc_id", "source")


def mix_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.mix(table(spark, sf_dir, "documents"), {"en": 60, "fr": 16, "de": 24}, "lang").select("doc_id", "lang")


def mix_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.shares(table(spark, sf_dir, "documents"), "lang").select("lang", "n", F.round("share", 6).alias("share"))


def citation_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts are works; each is cited once, whole, or with one, two or three edits at changing places."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_brand", "p_name", F.col("p_partkey") % 10).alias("work"))
    at = F.pmod(F.col("id") * 7, F.length("work")) + 1
    spoiled = F.when(F.col("id") % 4 == 0, F.col("work")).when(F.col("id") % 4 == 1, F.concat(F.substr("work", F.lit(1), at - 1), F.lit("#"), F.substr("work", at + 1)))
    spoiled = spoiled.when(F.col("id") % 4 == 2, F.concat(F.lit("%"), F.substr("work", F.lit(1), at - 1), F.substr("work", at + 1))).otherwise(F.concat(F.substr("work", F.lit(1), at), F.lit("###"), F.substr("work", at + 1)))
    return citations.verify(p.select(F.col("id").alias("example_id"), spoiled.alias("citation")), p.select(F.col("work").alias("citation")))


def judge_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    long = lab.select(F.col("doc_id").alias("example_id"), F.expr("stack(2, 'a', 1 + 4 * quality, 'b', 5 - 4 * toxic) AS (judge, score)"))
    return gates.judge_pass(long)


def audit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    passes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("example_id"), F.col("quality").alias("pass1"), (1 - F.col("toxic")).alias("pass2"))
    return reports.audit(passes).select("n", F.round("disagreement", 6).alias("disagreement"), "rejudge")


def win_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "events").select(F.col("user_id").alias("item_id"), F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0).alias("win"))
    return reports.win_rate(j, 0.2).select("items", F.round("rate", 6).alias("rate"), "reached")


def survival(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = F.when(F.length("text") < 200, "short").when(F.col("lang") != "en", "foreign").otherwise("kept")
    return reports.survival(table(spark, sf_dir, "documents").withColumn("stage", stage), "stage", ["short", "foreign", "kept"]).select("stage", "n", F.round("share", 6).alias("share"))


def budget_admit(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("tokens", F.length("props"))
    return ledger.admit(e, 40, ["user_id"], "tokens").filter("admitted").select("event_id", "used")


def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.latest(table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type"), ["user_id"]).select("user_id", "event_id", "event_type")


def outstanding_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    work = e.select("user_id", F.to_date("ts").alias("day")).distinct()
    return ledger.outstanding(work, e.select("user_id", F.to_date("ts").alias("day"), F.when(F.col("event_type") == "purchase", "done").alias("status")), ["user_id", "day"]).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_days"))


def batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = ledger.batches(table(spark, sf_dir, "documents"), "source", "doc_id")
    return b.groupBy("source", "batch_id").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))


def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.newest(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", 2).select("o_custkey", "o_orderkey")


def run_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("run_id"), F.col("p_size").alias("max_steps"), F.lit(60).alias("save_steps"))
    over = table(spark, sf_dir, "part").filter("p_partkey % 3 = 0").select(F.col("p_partkey").alias("run_id"), F.when(F.col("p_partkey") % 2 == 0, 0).alias("max_steps"))
    out = manifest.overlay(base, over)
    return out.withColumn("warmup", manifest.warmup_steps(F.lit(0.03), F.col("max_steps")))


def snapshot_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    markers = n.filter("n_nationkey % 2 = 0").select(F.concat(F.lit("/staged/"), "n_name").alias("path"), F.concat_ws(" ", "n_name", F.concat(F.lit("sha"), F.col("n_nationkey") % 10)).alias("value"))
    return manifest.resolve_sources(n.select(F.col("n_name").alias("repo"), F.concat(F.lit("sha"), F.col("n_nationkey") % 10).alias("revision")), markers)


def page_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_pages(spread(table(spark, sf_dir, "pages"))).select("page_id", "host", "url", F.length("text").cast("long").alias("n_text"), F.md5("text").alias("text_hash"))


def think_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    content = F.when(F.col("role") == "assistant", F.concat(F.lit("<think>plan</think>"), "text")).otherwise(F.col("text"))
    m = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", content.alias("content")))).alias("m"))
    kept = chat.strip_think_history(F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))))
    return m.select("conv_id", chat.occurrences(chat.render_messages(kept), "<think>").alias("n_think"), F.length(chat.render_messages(kept)).cast("long").alias("n_chars"))


def provenance_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "chunk_id")
    out = assembly.with_provenance(table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "chunk_id").select("chunk_id", "lang"), lab)
    return out.select("chunk_id", "lang", "provenance.quality", "provenance.toxic")


def grounded_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are no benchmark text and hold none as their whole first line."""
    d, g = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    first = F.substring_index("text", "\n", 1)
    return assembly.not_verbatim(assembly.not_verbatim(d, g).withColumn("line", first), g, "line").select("doc_id")


def hallucination_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly.sampled_rate(table(spark, sf_dir, "documents"), F.col("text").contains("Licen")).select("n", F.round("rate", 6).alias("rate"))


def source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly.admitted_sources(table(spark, sf_dir, "documents"), F.length("text") >= 500, "source", 0.8, 500).select("source", "audited", F.round("pass_rate", 6).alias("pass_rate"), "admitted")


def paired_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter("event_type IN ('signup', 'purchase')")
    scores = e.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).cast("double").alias("score"))
    r = scores.select(F.lit("count").alias("instrument"), F.when(F.col("event_type") == "signup", "base").otherwise("adapter").alias("model"), F.col("user_id").alias("item_id"), "score")
    return assembly.paired(r).select("item_id", "baseline", "adapter")


def builder_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = chat.mask_coverage(chat.render_long(table(spark, sf_dir, "conversations")))
    return assembly.builder_gates(rendered, F.ceil(F.col("n_chars") / 4), most=2048)


def reasoning_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly.share_reached(table(spark, sf_dir, "documents"), F.col("lang") == "en", 0.6).select(F.round("share", 6).alias("share"), "ok")


def assembled_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotas = {"en": 300, "fr": 80, "de": 120}
    out = assembly.assemble(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), quotas, "source", "lang", gates.rule_floors(20, ("en", "fr", "de")))
    return out.select("doc_id", "lang", "source", "split")


def probe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 8 groups of at least 6,000 characters, over all conversations in order."""
    t = table(spark, sf_dir, "conversations").filter("role <> 'system'").groupBy("conv_id").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"))
    return folds.first_groups(t, "conv_id", "chars", folds.least_chars(None, 1000), 8).groupBy("group_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("chars").alias("chars"))


def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as nested JSON lines, staged, counted, published, and read back under their schema."""
    c = turns.require_rows(table(spark, sf_dir, "conversations"), 10)
    turn = F.struct(F.col("turn"), F.col("role").alias("from"), F.col("text").alias("value"))
    nested = c.groupBy(F.col("conv_id").alias("ordinal")).agg(F.transform(F.array_sort(F.collect_list(turn)), lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value"))).alias("conversations"))
    path = shared_path(spark, "lines")
    write_jsonl(nested, path, least=10)
    back = turns.first_turns_nested(read_jsonl(spark, path, CONVERSATION, own=True))
    return back.select(F.col("ordinal").alias("conv_id"), F.size("conversations").cast("long").alias("n_turns"), F.length("user").cast("long").alias("n_user"))


def judge_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three judges, of which one is of the generator's family and another's family depends on the row."""
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("example_id"), "quality")
    family = F.expr("stack(3, 'a', 'x', 'b', CASE WHEN quality = 1 THEN 'y' ELSE 'x' END, 'c', 'g') AS (judge, judge_family)")
    return gates.judge_pairs(lab.select("example_id", F.lit("g").alias("generator_family"), family)).select("example_id", "judge_a", "judge_b")


def citation_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    cited = F.array(F.concat(F.lit("IPC "), "p_size"), F.concat(F.lit("BNS "), F.col("p_partkey") % 7))
    grounded = F.when(F.col("p_partkey") % 2 == 0, F.array(F.concat(F.lit("IPC "), "p_size"))).otherwise(F.array(F.lit("BNS 3"), F.lit("CRPC 1")))
    out = citations.ungrounded(p.select("p_partkey", cited.alias("cited"), grounded.alias("grounded")))
    return out.select("p_partkey", F.array_join("extra", ",").alias("extra"), F.array_join("cross_code", ",").alias("cross_code"))


def decision_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as instruments: shares of toxic and of good documents as the scores before and after."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    r = d.groupBy(F.when(F.col("lang") == "en", "target").otherwise(F.col("lang")).alias("instrument")).agg((100 * F.avg("toxic")).alias("baseline"), (100 * F.avg("quality")).alias("adapter"))
    return reports.decide(r).select(F.round("delta", 6).alias("delta"), F.round("worst_guard", 6).alias("worst_guard"), "decision")


def run_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes, waits, precision and step tokens of pinned runs, one a part."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("run_id"), "p_size", F.concat(F.lit("sha"), "p_partkey").alias("revision"))
    flags, size = manifest.precision_flags(F.col("p_size") > 25), F.col("p_size").cast("long")
    return manifest.require_pin(p).select(
        "run_id", "revision", reports.dataset_size(size, F.lit(438), F.lit(2500)).alias("examples"), ledger.backoff(size % 12, 1.0, 300.0).alias("wait_s"), flags["fp16"].alias("fp16"), flags["bf16"].alias("bf16"),
        manifest.tokens_per_step(size, F.lit(1), F.lit(2), F.lit(2)).alias("step_tokens"),
    )


def mode_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    modes = spark.createDataFrame([("F", ["--max-steps", "60"]), ("O", ["--probe"]), ("P", [])], "mode string, args array<string>")
    out = manifest.mode_args(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("mode")), modes)
    return out.select("o_orderkey", F.array_join("args", " ").alias("args"))


def decontam_quotable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared 13-grams, but for those of texts that may be quoted: here the benchmark's own texts of up to 200 characters."""
    b = table(spark, sf_dir, "benchmark")
    return decontam.contaminated(spread(table(spark, sf_dir, "documents")), b, quotable=b.filter(F.length("text") <= 200))


def win_rate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is judged twice, in either order of the two answers: an item's score is the mean of both."""
    o = table(spark, sf_dir, "orders")
    ahead, behind = F.when(F.col("o_totalprice") > 150000, 1.0).otherwise(0.0), F.when(F.col("o_orderpriority") < "3", 1.0).otherwise(0.0)
    both = o.select(F.col("o_orderkey").alias("item_id"), F.explode(F.array(ahead, behind)).alias("win"))
    return reports.win_rate(both).select("items", F.round("rate", 6).alias("rate"), "reached")


def device_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as runs, orders as readings: peaks by device (the year's parity) in units of 10 ** 9."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run_id"), (F.year("o_orderdate") % 2).alias("device"), (F.col("o_totalprice") * 100000).cast("long").alias("peak_bytes"))
    return reports.device_peaks(o).select("run_id", "peak_gb", F.size("per_device").cast("long").alias("devices"))


def run_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.lit(60).alias("steps"), F.lit(1).alias("batch"), F.lit(2).alias("accum"), F.lit(8192).alias("seq"), F.col("o_totalprice").cast("double").alias("runtime_s"), (F.col("o_orderstatus") == "P").alias("resumed"), F.lit(2).alias("world_size"))
    return reports.throughput(o).select("o_orderkey", F.round("tok_per_sec_rank", 4).alias("rank_rate"), F.round("tok_per_sec", 4).alias("rate"))


QUERIES = {
    f.__name__: f
    for f in (
        smoke_sft, smoke_skip_counts, chatml_render, mask_coverage, think_history, probe_greedy, pack_bins, nonfinite_streak, length_histogram, drop_overlength, rule_floors, rule_survival,
        lang_toxic_filter, license_filter, exact_dedup, minhash_signature, lsh_candidates, near_dup_pairs, decontam_13gram, embed_screen, embed_calibrated, chunk_words, chunk_paragraphs, holdout_split,
        mix_quota, mix_shares, citation_fuzzy, judge_pass, audit_rate, win_rate, survival, budget_admit, latest_status, outstanding_work, batch_requests, retention, run_overlay,
        snapshot_sources, page_ingest, provenance_join, grounded_only, hallucination_rate, source_audit, paired_eval, builder_gates, reasoning_share, assembled_set,
        probe_first, jsonl_round_trip, judge_panel, citation_scope, decision_gate, run_budget, mode_requests, decontam_quotable, win_rate_orders, device_report, run_throughput,
    )
}

_WS = r"[\s\x0b\x1c-\x1f\x85\xa0]"
_TURNS = f"""
f AS (SELECT conv_id, regexp_replace(coalesce(arg_min(coalesce(text, ''), turn) FILTER (role = 'user'), ''), '^{_WS}+|{_WS}+$', '', 'g') AS u,
             regexp_replace(coalesce(arg_min(coalesce(text, ''), turn) FILTER (role = 'assistant'), ''), '^{_WS}+|{_WS}+$', '', 'g') AS a,
             coalesce((list(text ORDER BY turn) FILTER (role = 'assistant'))[2], '') AS s FROM conversations GROUP BY conv_id),
m AS (SELECT conv_id, u, CASE WHEN conv_id % 3 <> 0 THEN '{BT}' || a || '{ET}' || chr(10) || '{BS}' || s || '{ES}' ELSE a END AS a FROM f),
p AS (SELECT conv_id, u, a, trim(replace(split_part(a, '{ET}', 1), '{BT}', ''), E' \\t\\n\\r') AS r,
             trim(replace(replace(substring(a, instr(a, '{ET}') + {len(ET)}), '{BS}', ''), '{ES}', ''), E' \\t\\n\\r') AS z FROM m),
k AS (SELECT conv_id, u, r, z, u <> '' AND a <> '' AND contains(a, '{ET}') AND r <> '' AND z <> '' AS ok FROM p)"""
_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
_SET = "list_distinct(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))"
_SIG = ", ".join(f"list_min(list_transform(w, lambda x: substring(sha256(x), {8 * k + 1}, 8)))" for k in range(8))
_SIGNED = f"s AS (SELECT doc_id, w, CASE WHEN len(w) > 0 THEN [{_SIG}] END AS sig FROM (SELECT doc_id, {_SET} AS w FROM documents))"
#: Pairs of rows x and y of a table that agree in the first, second, third or fourth quarter of their signatures, found quarter by quarter.
_MEET = """SELECT DISTINCT x.{id} AS a, y.{id} AS b FROM (SELECT {id}, sig, q, sig[2 * q + 1:2 * q + 2] AS own FROM {t}, range(4) r(q)) x
    JOIN (SELECT {id}, sig, q, sig[2 * q + 1:2 * q + 2] AS own FROM {t}, range(4) r(q)) y ON x.q = y.q AND x.own = y.own AND x.{id} < y.{id}"""
_GRAMS = "SELECT DISTINCT {key}, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT {key}, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM {table}), unnest(range(1, len(w) - 11)) t(i)"
_FLOORS = """
CASE WHEN coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) >= 20, false) THEN NULL ELSE 'length' END AS r1,
CASE WHEN coalesce(lang IN ('en'), false) THEN NULL ELSE 'language' END AS r2,
CASE WHEN coalesce(NOT contains(text, '|') AND regexp_matches(trim(text), '[.!?]$'), false) THEN NULL ELSE 'structure' END AS r3"""

ORACLE_SQL = {
    "smoke_sft": f"WITH {_TURNS} SELECT conv_id, u AS prompt, '<think>' || r || '</think>' || z AS response FROM k WHERE ok ORDER BY conv_id LIMIT 1000",
    "smoke_skip_counts": f"""WITH {_TURNS}, n AS (SELECT *, sum(ok::INT) OVER (ORDER BY conv_id) - ok::INT AS before FROM k)
        SELECT count_if(ok)::BIGINT AS written, count_if(NOT ok)::BIGINT AS skipped FROM n WHERE before < 20""",
    "chatml_render": """SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS text
        FROM conversations GROUP BY conv_id""",
    "mask_coverage": """SELECT conv_id, sum(length(role) + length(coalesce(text, '')) + 24)::BIGINT AS n_chars,
        coalesce(sum(length(coalesce(text, ''))) FILTER (role = 'assistant'), 0)::BIGINT AS trained_chars, count_if(role = 'assistant')::BIGINT AS n_responses
        FROM conversations GROUP BY conv_id""",
    "think_history": """WITH c AS (SELECT *, role = 'assistant' AND turn = max(turn) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) AS latest FROM conversations)
        SELECT conv_id, count_if(latest)::BIGINT AS n_think, sum(length(role) + length(text) + 24 + CASE WHEN latest THEN 19 ELSE 0 END)::BIGINT AS n_chars FROM c GROUP BY conv_id""",
    "probe_greedy": """WITH RECURSIVE u AS (SELECT conv_id, sum(length(coalesce(text, ''))) AS chars FROM conversations WHERE role <> 'system' GROUP BY conv_id),
        t AS (SELECT conv_id, conv_id % (SELECT greatest(1, CAST(ceil(count(*) / 100000) AS BIGINT)) FROM u) AS shard, chars FROM u),
        o AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY conv_id) AS k FROM t),
        f(shard, k, conv_id, chars, grp, acc) AS (
          SELECT shard, k, conv_id, chars, 0, chars FROM o WHERE k = 1
          UNION ALL SELECT o.shard, o.k, o.conv_id, o.chars, CASE WHEN f.acc >= 6000 THEN f.grp + 1 ELSE f.grp END, CASE WHEN f.acc >= 6000 THEN o.chars ELSE f.acc + o.chars END
          FROM f JOIN o ON o.shard = f.shard AND o.k = f.k + 1)
        SELECT shard, grp::BIGINT AS group_id, count(*) AS n_rows, sum(chars)::BIGINT AS chars, min(conv_id) AS first_conv FROM f GROUP BY shard, grp HAVING sum(chars) >= 6000""",
    "probe_first": """WITH RECURSIVE t AS (SELECT conv_id, sum(length(coalesce(text, ''))) AS chars FROM conversations WHERE role <> 'system' GROUP BY conv_id),
        o AS (SELECT *, row_number() OVER (ORDER BY conv_id) AS k FROM t),
        f(k, chars, grp, acc) AS (SELECT k, chars, 0, chars FROM o WHERE k = 1
          UNION ALL SELECT o.k, o.chars, CASE WHEN f.acc >= 6000 THEN f.grp + 1 ELSE f.grp END, CASE WHEN f.acc >= 6000 THEN o.chars ELSE f.acc + o.chars END FROM f JOIN o ON o.k = f.k + 1 WHERE f.grp < 8)
        SELECT grp::BIGINT AS group_id, count(*) AS n_rows, sum(chars)::BIGINT AS chars FROM f WHERE grp < 8 GROUP BY grp HAVING sum(chars) >= 6000""",
    "jsonl_round_trip": f"""SELECT conv_id, count(*) AS n_turns, length(regexp_replace(arg_min(coalesce(text, ''), turn) FILTER (role = 'user'), '^{_WS}+|{_WS}+$', '', 'g')) AS n_user FROM conversations GROUP BY conv_id""",
    "judge_panel": "SELECT doc_id AS example_id, 'a' AS judge_a, 'b' AS judge_b FROM labels WHERE quality = 1",
    "citation_scope": """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'BNS ' || (p_partkey % 7) ELSE 'IPC ' || p_size || CASE WHEN p_partkey % 7 <> 3 THEN ',BNS ' || (p_partkey % 7) ELSE '' END END AS extra,
        CASE WHEN p_partkey % 2 = 0 THEN 'BNS' ELSE 'IPC' END AS cross_code FROM part""",
    "decision_gate": """WITH r AS (SELECT CASE WHEN lang = 'en' THEN 'target' ELSE lang END AS i, 100 * avg(quality) - 100 * avg(toxic) AS d FROM documents JOIN labels USING (doc_id) GROUP BY 1),
        o AS (SELECT max(d) FILTER (i = 'target') AS t, min(d) FILTER (i <> 'target') AS g FROM r)
        SELECT round(t, 6) AS delta, round(g, 6) AS worst_guard, CASE WHEN coalesce(g, 0) < -2 THEN 'stop' WHEN t >= 3 THEN 'scale' WHEN t > 0 THEN 'confirm' ELSE 'stop' END AS decision FROM o""",
    "run_budget": """SELECT p_partkey AS run_id, 'sha' || p_partkey AS revision, CAST(p_size AS BIGINT) * 438 * 3600 // 2500 AS examples, least(300.0::DOUBLE, pow(2.0::DOUBLE, p_size % 12)) AS wait_s,
        p_size <= 25 AS fp16, p_size > 25 AS bf16, CAST(p_size AS BIGINT) * 4 AS step_tokens FROM part""",
    "mode_requests": "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '--max-steps 60' WHEN 'O' THEN '--probe' ELSE '' END AS args FROM orders",
    "decontam_quotable": f"""WITH d AS ({_GRAMS.format(key="doc_id", table="documents")}), p AS ({_GRAMS.format(key="item_id", table="benchmark")}),
        q AS (SELECT DISTINCT p.g FROM p JOIN benchmark b ON p.item_id = b.item_id WHERE length(b.text) <= 200)
        SELECT doc_id, count(*) AS n_shared FROM d WHERE g IN (SELECT g FROM p) AND g NOT IN (SELECT g FROM q) GROUP BY doc_id""",
    "win_rate_orders": """WITH i AS (SELECT ((o_totalprice > 150000)::INT + (o_orderpriority < '3')::INT) / 2 AS w FROM orders)
        SELECT count(*) AS items, round(avg(w), 6) AS rate, avg(w) >= 0.55 AS reached FROM i""",
    "device_report": """WITH e AS (SELECT o_custkey, year(o_orderdate) % 2 AS d, max(CAST(trunc(o_totalprice * 100000) AS BIGINT)) AS b FROM orders GROUP BY ALL)
        SELECT o_custkey AS run_id, round(max(b) / 1e9, 2) AS peak_gb, count(*) AS devices FROM e GROUP BY o_custkey""",
    "run_throughput": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN round(983040 / o_totalprice, 4) END AS rank_rate, CASE WHEN o_orderstatus <> 'P' THEN round(983040 / o_totalprice * 2, 4) END AS rate FROM orders""",
    "nonfinite_streak": """WITH l AS (SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step, event_type FROM events),
        s AS (SELECT *, event_type = 'error' AS bad FROM l WHERE step > 2 AND event_type <> 'view'),
        i AS (SELECT *, sum((NOT bad)::INT) OVER (PARTITION BY run_id ORDER BY step) AS island FROM s),
        n AS (SELECT run_id, step, row_number() OVER (PARTITION BY run_id, island ORDER BY step) AS streak FROM i WHERE bad)
        SELECT run_id, min(step) AS fired_step FROM n WHERE streak >= 2 GROUP BY run_id""",
    "length_histogram": """SELECT lang, quantile_cont(length(text), 0.5) AS p50, quantile_cont(length(text), 0.9) AS p90, quantile_cont(length(text), 0.99) AS p99,
        max(length(text)) AS longest, count(*) AS n FROM documents GROUP BY lang""",
    "drop_overlength": "SELECT doc_id FROM documents WHERE ceil(length(text) / 4) <= 2048",
    "rule_floors": f"SELECT doc_id, concat_ws(',', r1, r2, r3) AS reasons FROM (SELECT doc_id, {_FLOORS} FROM documents)",
    "rule_survival": f"""WITH r AS (SELECT doc_id, {_FLOORS} FROM documents)
        SELECT reason, count(*) AS n FROM (SELECT unnest(CASE WHEN coalesce(r1, r2, r3) IS NULL THEN ['passed'] ELSE [r1, r2, r3] END) AS reason FROM r) WHERE reason IS NOT NULL GROUP BY reason""",
    "lang_toxic_filter": "SELECT doc_id, source FROM documents d WHERE lang = 'en' AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)",
    "license_filter": """SELECT doc_id, license FROM (SELECT doc_id, CASE WHEN contains(lower(text), 'apache license') THEN 'apache' WHEN contains(lower(text), 'mit license') THEN 'mit'
        WHEN contains(lower(text), 'gnu general public license') THEN 'gpl' WHEN contains(lower(text), 'all rights reserved') THEN 'reserved' END AS license FROM documents)
        WHERE license IN ('apache', 'mit')""",
    "exact_dedup": "SELECT min(doc_id) AS doc_id, count(*) AS n_copies FROM documents GROUP BY coalesce(text, '')",
    "minhash_signature": f"WITH {_SIGNED} SELECT doc_id, array_to_string(sig, '') AS sig FROM s",
    "lsh_candidates": f"WITH {_SIGNED}, g AS (SELECT min(doc_id) AS doc_id, sig FROM s WHERE sig IS NOT NULL GROUP BY sig) {_MEET.format(id='doc_id', t='g')}",
    "near_dup_pairs": f"""WITH {_SIGNED}, d AS (SELECT doc_id, list_sort(w) AS w, sig FROM s WHERE sig IS NOT NULL),
        f AS (SELECT min(doc_id) AS doc_id, w, min(sig) AS sig FROM d GROUP BY w), m AS ({_MEET.format(id='doc_id', t='f')}),
        j AS (SELECT m.a, m.b, len(list_intersect(x.w, y.w)) AS i, len(x.w) + len(y.w) AS n FROM m JOIN f x ON m.a = x.doc_id JOIN f y ON m.b = y.doc_id)
        SELECT a, b, round(i / (n - i), 6) AS jaccard FROM j WHERE i / (n - i) >= 0.8::DOUBLE
        UNION ALL SELECT f.doc_id AS a, d.doc_id AS b, 1.0::DOUBLE AS jaccard FROM d JOIN f ON d.w = f.w AND d.doc_id > f.doc_id""",
    "decontam_13gram": f"""WITH d AS ({_GRAMS.format(key="doc_id", table="documents")}), p AS ({_GRAMS.format(key="item_id", table="benchmark")})
        SELECT doc_id, count(*) AS n_shared FROM d WHERE g IN (SELECT g FROM p) GROUP BY doc_id""",
    "embed_screen": """SELECT v.vec_id, count(*) AS n_near FROM embeddings v JOIN embeddings p ON p.label = 0 AND p.vec_id <> v.vec_id
        WHERE list_cosine_similarity(v.embedding::DOUBLE[], p.embedding::DOUBLE[]) >= 0.35 GROUP BY v.vec_id""",
    "embed_calibrated": """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
        n AS (SELECT floor(10000 * list_cosine_similarity(a.x, b.x)) AS g FROM e a JOIN e b ON b.vec_id = a.vec_id + 1 AND a.label <> b.label),
        t AS (SELECT min(g) AS g FROM (SELECT DISTINCT g + 1 AS g FROM n) s WHERE (SELECT count(*) FROM n WHERE n.g >= s.g) <= 0.01 * (SELECT count(*) FROM n))
        SELECT v.vec_id, count(*) AS n_near, any_value(t.g / 10000::DOUBLE) AS threshold FROM e v JOIN e p ON p.label = 0 AND p.vec_id <> v.vec_id, t
        WHERE list_cosine_similarity(v.x, p.x) >= t.g / 10000::DOUBLE GROUP BY v.vec_id""",
    "chunk_words": f"""WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents)
        SELECT doc_id, i AS chunk_ix, md5(array_to_string(w[i * 256 + 1:i * 256 + 256], ' ')) AS chunk_hash, len(w[i * 256 + 1:i * 256 + 256]) AS n_words
        FROM w, unnest(range(CAST(ceil(len(w) / 256) AS BIGINT))) t(i)""",
    "holdout_split": """SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('3407:' || doc_id), doc_id) AS k,
        count(*) OVER (PARTITION BY source) AS n FROM documents) WHERE k <= CAST(floor(0.1::DOUBLE * n) AS BIGINT)""",
    "mix_quota": """SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('3407:' || doc_id), doc_id) AS k FROM documents)
        WHERE k <= CASE lang WHEN 'en' THEN 60 WHEN 'fr' THEN 16 WHEN 'de' THEN 24 ELSE 0 END""",
    "mix_shares": "SELECT lang, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 6) AS share FROM documents GROUP BY lang",
    "citation_fuzzy": """WITH p AS (SELECT p_partkey AS id, concat_ws(' ', p_brand, p_name, p_partkey % 10) AS work FROM part),
        q AS (SELECT *, CAST(id * 7 % length(work) AS INT) + 1 AS k FROM p),
        c AS (SELECT id, CASE id % 4 WHEN 0 THEN work WHEN 1 THEN left(work, k - 1) || '#' || substring(work, k + 1) WHEN 2 THEN '%' || left(work, k - 1) || substring(work, k + 1)
              ELSE left(work, k) || '###' || substring(work, k + 1) END AS c FROM q),
        w AS (SELECT DISTINCT work FROM p),
        e AS (SELECT c.id, c.c, bool_or(w.work = c.c) AS x, bool_or(levenshtein(w.work, c.c) <= 2) AS y FROM c JOIN w ON abs(length(w.work) - length(c.c)) <= 2 GROUP BY c.id, c.c)
        SELECT c.id AS example_id, 1::BIGINT AS n_cited, coalesce(x, false)::BIGINT AS n_exact, (coalesce(y, false) AND NOT coalesce(x, false))::BIGINT AS n_fuzzy, coalesce(x OR y, false) AS ok
        FROM c LEFT JOIN e ON c.id = e.id""",
    "judge_pass": "SELECT doc_id AS example_id, bool_and(1 + 4 * quality >= 4 AND 5 - 4 * toxic >= 4) AS passed FROM labels GROUP BY doc_id",
    "audit_rate": "SELECT count(*) AS n, round(avg((quality <> 1 - toxic)::INT), 6) AS disagreement, avg((quality <> 1 - toxic)::INT) > 0.15 AS rejudge FROM labels",
    "win_rate": """WITH i AS (SELECT user_id, avg(CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0.0 END) AS w FROM events GROUP BY user_id)
        SELECT count(*) AS items, round(avg(w), 6) AS rate, avg(w) >= 0.2 AS reached FROM i""",
    "survival": """WITH c AS (SELECT count(*) AS n0, count_if(length(text) >= 200)::BIGINT AS n1, count_if(length(text) >= 200 AND lang = 'en')::BIGINT AS n2 FROM documents)
        SELECT 'short' AS stage, n0 AS n, round(n0 / n0, 6) AS share FROM c UNION ALL SELECT 'foreign', n1, round(n1 / n0, 6) FROM c UNION ALL SELECT 'kept', n2, round(n2 / n1, 6) FROM c""",
    "budget_admit": """SELECT event_id, used FROM (SELECT event_id, sum(length(props)) OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS used FROM events)
        WHERE used <= 40""",
    "latest_status": "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1",
    "outstanding_work": """SELECT user_id, count(*) AS n_days FROM (SELECT user_id, ts::DATE AS day FROM events GROUP BY ALL HAVING count_if(event_type = 'purchase') = 0) GROUP BY user_id""",
    "batch_requests": """SELECT source, b AS batch_id, count(*) AS n, min(doc_id) AS first_id
        FROM (SELECT source, doc_id, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 10 AS b FROM documents) GROUP BY source, b""",
    "retention": "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS k FROM orders) WHERE k <= 2",
    "run_overlay": """SELECT p_partkey AS run_id, m AS max_steps, 60 AS save_steps, round_even(0.03::DOUBLE * m, 0)::INT AS warmup
        FROM (SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN 0 ELSE p_size END AS m FROM part)""",
    "snapshot_sources": """WITH m AS (SELECT n_nationkey % 10 AS k, min('/staged/' || n_name) AS path FROM nation WHERE n_nationkey % 2 = 0 GROUP BY 1)
        SELECT n_name AS repo, coalesce(path, n_name) AS source, CASE WHEN path IS NULL THEN 'sha' || (n_nationkey % 10) END AS revision FROM nation LEFT JOIN m ON n_nationkey % 10 = k""",
    "page_ingest": r"""WITH p AS (SELECT page_id, regexp_replace(lower(url), '[?#].*$|/+$', '', 'g') AS url,
        trim(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<[^>]*>', ' ', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS t FROM pages)
        SELECT page_id, regexp_extract(url, '^[a-z]+://([^/:]+)', 1) AS host, url, length(t) AS n_text, md5(t) AS text_hash FROM p""",
    "provenance_join": "SELECT d.doc_id AS chunk_id, lang, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
    "grounded_only": """SELECT doc_id FROM documents WHERE text IS NULL
        OR trim(text) NOT IN (SELECT trim(text) FROM benchmark WHERE text IS NOT NULL) AND trim(split_part(text, chr(10), 1)) NOT IN (SELECT trim(text) FROM benchmark WHERE text IS NOT NULL)""",
    "hallucination_rate": """SELECT count(*) AS n, round(avg(coalesce(contains(text, 'Licen'), false)::INT), 6) AS rate
        FROM (SELECT * FROM documents ORDER BY md5('3407:' || doc_id), doc_id LIMIT 200)""",
    "source_audit": """WITH r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('3407:' || doc_id), doc_id) AS k FROM documents)
        SELECT source, count(*) AS audited, round(avg(coalesce(length(text) >= 500, false)::INT), 6) AS pass_rate, avg(coalesce(length(text) >= 500, false)::INT) >= 0.8 AS admitted
        FROM r WHERE k <= 500 GROUP BY source""",
    "paired_eval": """WITH s AS (SELECT event_type, user_id, count(*)::DOUBLE AS n FROM events GROUP BY ALL),
        a AS (SELECT * FROM s WHERE event_type = 'signup'), b AS (SELECT * FROM s WHERE event_type = 'purchase')
        SELECT coalesce(a.user_id, b.user_id) AS item_id, a.n AS baseline, b.n AS adapter FROM a FULL JOIN b ON a.user_id = b.user_id""",
    "builder_gates": """WITH r AS (SELECT conv_id, sum(length(role) + length(coalesce(text, '')) + 24) AS n,
        coalesce(sum(length(coalesce(text, ''))) FILTER (role = 'assistant'), 0) AS t, bool_or(contains(coalesce(text, ''), '<|endoftext|>')) AS p FROM conversations GROUP BY conv_id),
        g AS (SELECT count(*) AS "rows", count_if(ceil(n / 4) > 2048)::BIGINT AS over_length, count_if(t = 0)::BIGINT AS unmasked, count_if(p)::BIGINT AS padded FROM r)
        SELECT *, over_length = 0 AND unmasked = 0 AND padded = 0 AS ok FROM g""",
    "reasoning_share": "SELECT round(avg((lang = 'en')::INT), 6) AS share, avg((lang = 'en')::INT) >= 0.6 AS ok FROM documents",
    "assembled_set": f"""WITH floors AS (SELECT doc_id, text, lang, source, {_FLOORS.replace("('en')", "('en', 'fr', 'de')")} FROM documents),
        fl AS (SELECT * FROM floors WHERE coalesce(r1, r2, r3) IS NULL AND length(text) <= 32768),
        s AS (SELECT doc_id, w, CASE WHEN len(w) > 0 THEN [{_SIG}] END AS sig FROM (SELECT doc_id, {_SET} AS w FROM fl)),
        v AS (SELECT * FROM s WHERE sig IS NOT NULL), c AS ({_MEET.format(id="doc_id", t="v")}),
        j AS (SELECT c.b, len(list_intersect(x.w, y.w)) AS i, len(x.w) + len(y.w) AS n FROM c JOIN s x ON c.a = x.doc_id JOIN s y ON c.b = y.doc_id),
        u AS (SELECT * FROM fl WHERE doc_id NOT IN (SELECT b FROM j WHERE i / (n - i) >= 0.8::DOUBLE)),
        d AS ({_GRAMS.format(key="doc_id", table="u")}), p AS ({_GRAMS.format(key="item_id", table="benchmark")}),
        k AS (SELECT * FROM u WHERE doc_id NOT IN (SELECT doc_id FROM d WHERE g IN (SELECT g FROM p))),
        h AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('3407:' || doc_id), doc_id) <= CAST(floor(0.1::DOUBLE * count(*) OVER (PARTITION BY source)) AS BIGINT) AS held FROM k),
        m AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('3407:' || doc_id), doc_id) AS r FROM h WHERE NOT held)
        SELECT doc_id, lang, source, 'train' AS split FROM m WHERE r <= CASE lang WHEN 'en' THEN 300 WHEN 'fr' THEN 80 WHEN 'de' THEN 120 ELSE 0 END
        UNION ALL SELECT doc_id, lang, source, 'held_out' FROM h WHERE held""",
}
