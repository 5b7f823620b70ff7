"""The operators of this package as queries over whole tables."""

from __future__ import annotations

import public_tokenizers

from strata.llm.alignment import align_corpus, document_measures
from strata.llm.ann import nearest_neighbours
from strata.llm.bpe import round_trips
from strata.llm.conversations import repair_report
from strata.llm.dedup import near_duplicates
from strata.llm.langid import fit_language_model, held_out, predict_languages
from strata.llm.licenses import scan_licenses
from strata.llm.lm import score_texts
from strata.llm.mixing import mix_report
from strata.llm.ngram_join import ngram_components
from strata.llm.shipping import ship
from strata.llm.token_counts import token_counts
from strata.llm.token_store import stored_documents, write_tokens
from strata.llm.topk import exact_top_k
from strata.session import working_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark, folder: str, name: str):
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_lm_scores(spark, folder):
    return score_texts(_table(spark, folder, "documents"))


def op2_bpe(spark, folder):
    return round_trips(_table(spark, folder, "documents"), BYTE_BPE)


def op3_nearest(spark, folder):
    return nearest_neighbours(_table(spark, folder, "embeddings"))


def op4_language(spark, folder):
    docs = _table(spark, folder, "documents")
    out = held_out(docs["doc_id"])
    predicted = predict_languages(docs, fit_language_model(docs.where(~out)))
    return predicted.select("doc_id", held_out(predicted["doc_id"]).alias("held_out"), "lang_pred", "score")


def op5_token_counts(spark, folder):
    return token_counts(_table(spark, folder, "documents"), BYTE_BPE)


def op6_token_files(spark, folder):
    target = working_folder(spark, "tokens")
    write_tokens(_table(spark, folder, "documents"), WORD_BPE, target)
    return stored_documents(spark, target)


def op7_mixture(spark, folder):
    return mix_report(_table(spark, folder, "documents"))


def op8_licenses(spark, folder):
    return scan_licenses(_table(spark, folder, "documents"))


def op9_top_k(spark, folder):
    return exact_top_k(_table(spark, folder, "embeddings"))


def op10_near_duplicates(spark, folder):
    return near_duplicates(_table(spark, folder, "documents"))


def op11_tokenizer_alignment(spark, folder):
    docs, target = _table(spark, folder, "documents"), working_folder(spark, "alignment")
    align_corpus(docs, BYTE_BPE, PIECE_BPE, target)
    return document_measures(docs, target)


def op12_conversation_repair(spark, folder):
    return repair_report(_table(spark, folder, "conversations"))


def op13_ngram_join(spark, folder):
    return ngram_components(_table(spark, folder, "documents"))


QUERIES = {
    "op1_lm_scores": op1_lm_scores,
    "op2_bpe": op2_bpe,
    "op3_nearest": op3_nearest,
    "op4_language": op4_language,
    "op5_token_counts": op5_token_counts,
    "op6_token_files": op6_token_files,
    "op7_mixture": op7_mixture,
    "op8_licenses": op8_licenses,
    "op9_top_k": op9_top_k,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_ngram_join": op13_ngram_join,
}
