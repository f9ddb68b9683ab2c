"""The registered query of each operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from stratacast.llm.chat import chat_digest, format_chats
from stratacast.llm.decontaminate import contamination
from stratacast.llm.licenses import default_templates, license_scan
from stratacast.llm.near_duplicates import near_duplicates
from stratacast.llm.pieces import PieceModel, round_trip
from stratacast.llm.pii import pii
from stratacast.llm.prefix_trie import prefix_trie
from stratacast.llm.quality_model import fit_quality, quality_scores
from stratacast.llm.quality_rules import quality_rules
from stratacast.llm.secret_scan import secrets
from stratacast.llm.source_divergence import source_divergence
from stratacast.llm.token_files import token_output
from stratacast.llm.toxicity import fit_toxicity, toxicity_scores

CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(file: str) -> bytes:
    """The content of a tokenizer file; a bare name is looked up among the installed public ones."""
    path = Path(file)
    if not path.is_file():
        import public_tokenizers

        path = Path(public_tokenizers.path(file))
    return path.read_bytes()


def tokenizer_definition(file: str) -> str:
    return tokenizer_file(file).decode()


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("hit_spans")


def op2_token_output(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    return token_output(_table(spark, sf_dir, "documents"), tokenizer_definition(tokenizer or "word_bpe_49k.json"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii(_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_scores(docs, fit_quality(docs, _table(spark, sf_dir, "labels")))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    told = [(-1, turn, role, CONTROL_TEXT) for turn, role in enumerate(("user", "assistant"))]
    rows = rows.unionByName(spark.createDataFrame(told, rows.schema))
    return chat_digest(format_chats(rows))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity_scores(docs, fit_toxicity(docs, _table(spark, sf_dir, "labels")))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"), default_templates(spark)).drop("spans")


def op10_pieces(spark: SparkSession, sf_dir: str, model_file: str = "piece_bpe_32k.model") -> DataFrame:
    """Encode, decode again, and report the ids' number and checksum and whether the text came back."""
    model = PieceModel.read(tokenizer_file(model_file))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, model)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_token_output": op2_token_output,
    "op3_pii": op3_pii,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_quality_rules": op5_quality_rules,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_toxicity": op7_toxicity,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_license_scan": op9_license_scan,
    "op10_pieces": op10_pieces,
    "op11_secret_scan": op11_secret_scan,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_source_divergence": op13_source_divergence,
}
