"""The registered queries of this subpackage: thin digests of its operators."""

from pyspark.sql import functions as F

from tillcast.llm import (
    codes, decontam, embeddings, folds, langid, lines, lm_blocks, minhash, packing, quality, sharding, substrings,
    toxicity, trie,
)


def _table(spark, base, name):
    return spark.read.parquet(f"{base}/{name}.parquet")


def op1_itq_embeddings(spark, base):
    return embeddings.near_duplicates(_table(spark, base, "embeddings"), 0.98)


def op2_circulant_minhash(spark, base):
    return minhash.near_duplicates(_table(spark, base, "documents"), words=2, similarity=(80, 100))


def op3_naive_bayes_language(spark, base):
    docs, fold = _table(spark, base, "documents"), folds.fold(5)
    return langid.predict(docs, langid.train(docs.where(fold != 0)), held_out=fold == 0)


def op4_backoff_automaton(spark, base):
    docs, fold = _table(spark, base, "documents"), folds.fold(5)
    return lm_blocks.score_corpus(docs, fold != 1, held_out=fold == 1)


def op5_mixture_packing(spark, base):
    return packing.pack(_table(spark, base, "documents"))


def packing_to_weights(spark, base):
    """Two sources get shares of their own, the others what their tokens amount to."""
    return packing.pack(_table(spark, base, "documents"), weights={"src0": 0.1, "src1": 0.2})


def op6_toxicity_grammar(spark, base):
    docs, fold = _table(spark, base, "documents"), folds.fold(3)
    model = toxicity.train(docs, _table(spark, base, "labels"), rows=fold != 1)
    return toxicity.score(docs, model, held_out=fold == 1)


def op7_quality_trees(spark, base):
    docs, fold = _table(spark, base, "documents"), folds.fold(4)
    model = quality.train(docs, _table(spark, base, "labels"), rows=fold != 2)
    return quality.score(docs, model, held_out=fold == 2)


def op8_line_windows(spark, base):
    found = lines.dedup_lines(_table(spark, base, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "text")


def op9_simhash_decontamination(spark, base):
    return decontam.find_matches(_table(spark, base, "documents"), _table(spark, base, "benchmark"))


def op10_label_propagation_shards(spark, base):
    return sharding.shard(_table(spark, base, "documents"))


def op11_centroid_trie(spark, base):
    return trie.prefix_trie(*trie.rebuilt(trie.numbered_turns(_table(spark, base, "conversations"))))


def op12_resident_codes(spark, base):
    return codes.compress(_table(spark, base, "embeddings"))


def op13_seed_extend(spark, base):
    found = substrings.remove_repeats(_table(spark, base, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_itq_embeddings, op2_circulant_minhash, op3_naive_bayes_language, op4_backoff_automaton, op5_mixture_packing,
    op6_toxicity_grammar, op7_quality_trees, op8_line_windows, op9_simhash_decontamination, op10_label_propagation_shards,
    op11_centroid_trie, op12_resident_codes, op13_seed_extend,
)}
#: Further uses of the operators.
EXTRA = {f.__name__: f for f in (packing_to_weights,)}
SQL = {"op1_itq_embeddings": embeddings.SQL, "op2_circulant_minhash": minhash.SQL, "op8_line_windows": lines.SQL,
       "op11_centroid_trie": trie.SQL, "op12_resident_codes": codes.SQL, "op13_seed_extend": substrings.SQL}
