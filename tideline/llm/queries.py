"""The registered queries of the document operators."""
from __future__ import annotations

from tideline.llm import check_sql
from tideline.llm.common import table
from tideline.plans.registry import Registry

llm = Registry()


@llm.add("op1_host_quality", check_sql.HOST_QUALITY)
def host_quality(spark, folder):
    from tideline.llm.quality_rules import host_quality
    return host_quality(table(spark, folder, "documents"))


@llm.add("op2_language_mixture")
def language_mixture(spark, folder):
    from tideline.llm.common import held_out
    from tideline.llm.language_mixture import identify, learn_from
    docs = table(spark, folder, "documents")
    return identify(docs, learn_from(docs)).withColumn("held_out", held_out())


@llm.add("op3_simhash_near_duplicates")
def simhash(spark, folder):
    from tideline.llm.simhash import near_duplicates
    return near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


@llm.add("op4_decontaminate")
def decontaminate(spark, folder):
    from tideline.llm.decontaminate import contaminated
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@llm.add("op5_line_block_text")
def html_text(spark, folder):
    from tideline.llm.html_text import extract
    return extract(table(spark, folder, "pages"))


@llm.add("op6_best_fit_packing")
def packing(spark, folder):
    from tideline.llm.packing import pack_documents
    return pack_documents(table(spark, folder, "documents"))


@llm.add("op7_extendible_shards", check_sql.EXTENDIBLE_SHARDS)
def shards(spark, folder):
    from tideline.llm.extendible_shards import shard_documents
    return shard_documents(table(spark, folder, "documents"))


@llm.add("op8_suffix_dedup")
def suffix_dedup(spark, folder):
    from tideline.llm.suffix_index import remove_repeats
    return remove_repeats(table(spark, folder, "documents"))


@llm.add("op9_rule_ensemble_quality")
def quality(spark, folder):
    from tideline.llm.common import held_out
    from tideline.llm.rule_ensemble import learn_from, quality
    docs = table(spark, folder, "documents")
    return quality(docs, learn_from(docs, table(spark, folder, "labels"))).withColumn("held_out", held_out())


@llm.add("op10_ordinal_severity")
def severity(spark, folder):
    from tideline.llm.common import held_out
    from tideline.llm.severity import learn_from, toxicity
    docs = table(spark, folder, "documents")
    return toxicity(docs, learn_from(docs, table(spark, folder, "labels"))).withColumn("held_out", held_out())


@llm.add("op11_packed_ids")
def packed_ids(spark, folder):
    from tideline.llm.packed_ids import stored_ids
    from tideline.session import shared_folder
    return stored_ids(spark, table(spark, folder, "documents"), shared_folder(spark, "packed-ids"))


@llm.add("op12_importance_resampling")
def importance(spark, folder):
    from tideline.llm.importance import resample
    return resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@llm.add("op13_periodic_runs")
def periodic_runs(spark, folder):
    from tideline.llm.periodic_runs import digests, periodic_runs, with_planted_runs
    docs = table(spark, folder, "documents").withColumn("text", with_planted_runs())
    return digests(periodic_runs(docs))
