"""The operators of this package as registered queries, with SQL where it can say the same."""

from __future__ import annotations

from loomframe.llm import (
    centroids,
    decontaminate,
    huffman,
    language,
    licenses,
    manifest,
    mixing,
    near_copies,
    packing,
    pii,
    quality,
    urls,
    warc,
)
from loomframe.llm.shared import table
from loomframe.plans.registry import Registry

plan = Registry()


@plan.add(quality.SQL)
def op4_quality_rules(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"))


@plan.add()
def op1_language_id(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@plan.add()
def op2_license_scan(spark, sf_dir):
    return licenses.find(table(spark, sf_dir, "documents"))


@plan.add()
def op3_huffman_ids(spark, sf_dir):
    return huffman.round_trip(spark, table(spark, sf_dir, "documents"))


@plan.add()
def op5_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@plan.add(decontaminate.SQL)
def op8_decontamination(spark, sf_dir):
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@plan.add(urls.SQL)
def op9_url_filter(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"))


@plan.add(near_copies.SQL)
def op7_ngram_jaccard(spark, sf_dir):
    return near_copies.find(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@plan.add(warc.SQL)
def op6_warc_round_trip(spark, sf_dir):
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


@plan.add()
def op10_personal_data(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents"))


@plan.add(manifest.SQL)
def op11_merkle_manifest(spark, sf_dir):
    return manifest.verify(table(spark, sf_dir, "documents"))


@plan.add(centroids.SQL)
def op13_centroid_clusters(spark, sf_dir):
    return centroids.report(table(spark, sf_dir, "embeddings"))


@plan.add()
def op12_mixture(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))
