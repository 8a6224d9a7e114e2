"""The registered queries of this package: name → function of (spark, folder of the tables), and their SQL."""

from __future__ import annotations

from eventlink.llm import (
    collocations,
    decontaminate,
    katz,
    language,
    licenses,
    minhash,
    oracles,
    packing,
    quality,
    resample,
    secrets,
    suffix_dedup,
    topk,
    warc,
)
from eventlink.llm.common import table
from eventlink.sources.folders import scratch_folder


def op1_decontamination(spark, sf):
    """Every document's words, its words inside windows of benchmark items, the items found and whether it is contaminated."""
    return decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op2_suffix_dedup(spark, sf):
    """Every document's bytes, those covered by 400-byte strings that also start elsewhere, their runs and a hash of the rest."""
    return suffix_dedup.repeat_report(table(spark, sf, "documents"))


def op3_packing(spark, sf):
    """Bucket, batch and place of every document, with the buckets' ends as the length histogram wants them."""
    return packing.pack(table(spark, sf, "documents"))


def op4_secret_scan(spark, sf):
    """Every document's base secrets by kind, a digest of their spans, and all spans."""
    return secrets.secret_digest(table(spark, sf, "documents"))


def op5_exact_topk(spark, sf):
    """The 20 greatest integer inner products of every twentieth vector with all others."""
    rows = topk.quantised(table(spark, sf, "embeddings"))
    return topk.top_k(rows, rows.where("id % 20 = 0"))


def op6_katz_score(spark, sf):
    """Every document's unigram base score and its log10 probability under the backoff model."""
    return katz.katz_report(table(spark, sf, "documents"))


def op7_quality(spark, sf):
    """Every document's quality score and prediction by the additive model."""
    return quality.quality_report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op8_near_duplicates(spark, sf):
    """The near-duplicate class of every document."""
    return minhash.near_duplicates(table(spark, sf, "documents"))


def op9_language(spark, sf):
    """Every document's predicted language with its score."""
    return language.language_report(table(spark, sf, "documents"))


def op10_license_scan(spark, sf):
    """Every document's base phrases, their places, and the labels found by phrases and templates."""
    return licenses.license_report(table(spark, sf, "documents"))


def op11_warc(spark, sf):
    """Every page's payload, type and reference as read back from the archives it was written to."""
    path = scratch_folder(spark, "warc")
    warc.write_warc(table(spark, sf, "pages"), path)
    return warc.page_report(warc.read_warc(spark, path, payload=False))


def op12_collocations(spark, sf):
    """The 2,000 best phrases of every language with their counts and score."""
    return collocations.collocations(table(spark, sf, "documents"))


def op13_importance_resampling(spark, sf):
    """Every document's weight and score towards the benchmark, and its rank if it is drawn."""
    return resample.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_packing": op3_packing,
    "op4_secret_scan": op4_secret_scan,
    "op5_exact_topk": op5_exact_topk,
    "op6_katz_score": op6_katz_score,
    "op7_quality": op7_quality,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_language": op9_language,
    "op10_license_scan": op10_license_scan,
    "op11_warc": op11_warc,
    "op12_collocations": op12_collocations,
    "op13_importance_resampling": op13_importance_resampling,
}
ORACLES: dict[str, str] = {
    "op1_decontamination": decontaminate.ORACLE,
    "op2_suffix_dedup": oracles.REPEATS,
    "op4_secret_scan": oracles.SECRETS,
    "op5_exact_topk": topk.ORACLE,
    "op8_near_duplicates": oracles.NEAR_DUPLICATES,
    "op10_license_scan": oracles.LICENSES,
    "op11_warc": warc.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_importance_resampling": resample.ORACLE,
}
