"""License scan by diagonal voting.

All rolling word k-grams of the documents are joined by hash to the places of
the same k-grams in license templates. Each hit votes for the offset between
the two, its diagonal; diagonals that lie nearer to each other than half the
template are merged, as a notice with words put in or left out is spread over
several of them, and the spans with enough votes are compared with the
template word by word.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratacast.llm.common import broadcast_within, item_words
from stratacast.llm.grams import count_mark, gram_hashes, marked, unpacked, with_word_hashes
from stratacast.session import ensure_checkpoint_dir

# Phrases of the base rule and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Paragraphs of public license notices.
NOTICES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See "
        "the License for the specific language governing permissions and limitations under the License",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
    ),
}
PHRASE_K, NOTICE_K = 2, 4
# Diagonals at most this share of the template's words apart belong to one place.
REACH = 0.5
# Runs of fewer equal words than this do not count towards a notice's score.
LEAST_RUN = 2
MIN_VOTES = 0.3
MIN_SCORE = 0.6
PHRASE_SCORE = 0.5
# Template grams and ids are at most 24 bytes a row.
BROADCAST_ROWS = 1_000_000

FOUND = (
    "n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label:string,start:int,end:int,score:double>>"
)


def default_templates(spark: SparkSession) -> DataFrame:
    """(label, text, base): the phrases of the base rule and the notices."""
    rows = [(label, text, True) for text, label in PHRASES.items()]
    rows += [(label, text, False) for label, texts in NOTICES.items() for text in texts]
    return spark.createDataFrame(rows, "label string, text string, base boolean")


def license_scan(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """Places of base phrases and verified notices, one row per document.

    ``docs`` has doc_id and text, ``templates`` label, text and base; other
    columns are ignored. A base phrase counts wherever its words (two or more)
    stand in a row; a notice counts once ``MIN_SCORE`` of its words are found
    in order, in runs of ``LEAST_RUN`` or more, within three lengths of the
    template, and half a length may be put in at one place. Of overlapping
    spans of a template the best is kept, the earlier one where they tie. A null text has no words. Rows that repeat an id give one row:
    the longest text counts words, places of equal words count once. Null ids
    form one document. Templates with fewer words than a gram match nothing;
    empty tables give no rows, or no labels.

    Columns: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, spans (word spans of everything found, from the first to the
    last word that agrees).
    """
    known = templates.select("label", "base", item_words(F.col("text")).alias("_words")).where(F.size("_words") > 0)
    known = known.withColumn("_template", F.xxhash64("label", "base", F.array_join("_words", " ")))
    ensure_checkpoint_dir(docs.sparkSession)

    parts = []
    for base, k in ((True, PHRASE_K), (False, NOTICE_K)):
        own = with_word_hashes(known.where(F.col("base") == base)).withColumn("_grams", gram_hashes("_hashes", k))
        n = own.select("_template", "base", F.size("_grams").alias("_total"), F.size("_words").alias("_size"))
        grams = unpacked(own, "_template", marked(gram_hashes("_hashes", k), k))
        parts.append(grams.withColumnRenamed("_at", "_t_at").join(n, "_template"))
    places = broadcast_within(parts[0].unionByName(parts[1]), BROADCAST_ROWS)
    wanted = known.select("_template", "label", "base", F.col("_words").alias("_known"))
    n_known = known.agg(F.sum(F.size("_words"))).first()[0] or 0
    wanted = F.broadcast(wanted) if n_known <= BROADCAST_ROWS else wanted

    texts = docs.select("doc_id", "text")
    words = with_word_hashes(texts.select("doc_id", item_words(F.col("text")).alias("_words")))
    words = words.withColumn("_n", F.size("_words"))
    rolled = unpacked(
        words,
        "doc_id",
        F.concat(
            marked(gram_hashes("_hashes", PHRASE_K), PHRASE_K),
            marked(gram_hashes("_hashes", NOTICE_K), NOTICE_K),
            count_mark(F.col("_n")),
        ),
    )
    # Counts of words travel with the hits, so one scan of the texts is enough for documents without any.
    votes = (
        rolled.join(places, ["_print", "_len"], "left")
        .where(F.col("_template").isNotNull() | (F.col("_len") == 0))
        .groupBy("doc_id", "_template", (F.col("_at") - F.col("_t_at")).alias("_diagonal"))
        .agg(
            F.count(F.lit(1)).alias("_votes"),
            F.min("_at").alias("_from"),
            F.max(F.col("_at") + F.col("_len")).alias("_to"),
            F.first("base").alias("_base"),
            F.first("_total").alias("_total"),
            F.first("_size").alias("_size"),
            F.max(F.when(F.col("_len") == 0, F.col("_print"))).alias("_n"),
        )
        .checkpoint()
    )
    counts = votes.where("_template IS NULL").select("doc_id", F.col("_n").alias("n_words"))
    hits = votes.where("_template IS NOT NULL")

    phrases = hits.where(F.col("_base") & (F.col("_votes") >= F.col("_total"))).select(
        "doc_id", "_template", F.col("_diagonal").alias("_from"), (F.col("_diagonal") + F.col("_size")).alias("_to")
    )
    order = Window.partitionBy("doc_id", "_template").orderBy("_diagonal")
    reach = F.greatest(F.lit(1), F.floor(REACH * F.col("_size")))
    islands = (
        hits.where(~F.col("_base"))
        .withColumn("_new", (F.col("_diagonal") - F.lag("_diagonal").over(order) > reach).cast("int"))
        .withColumn("_island", F.sum(F.coalesce("_new", F.lit(0))).over(order))
        .groupBy("doc_id", "_template", "_island")
        .agg(
            F.sum("_votes").alias("_votes"),
            F.min("_from").alias("_from"),
            F.max("_to").alias("_to"),
            F.first("_total").alias("_total"),
            F.first("_size").alias("_size"),
        )
        .where(F.col("_votes") >= MIN_VOTES * F.col("_total"))
        # Chains of diagonals may run on; they are read in windows of three lengths of the template, one length apart,
        # so that each stretch of two lengths lies in one of them.
        .withColumn("_last", F.greatest(F.lit(0), F.ceil((F.col("_to") - F.col("_from")) / F.col("_size")).cast("int") - 3))
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.col("_last"))))
        .withColumn("_from", F.col("_from") + F.col("_step") * F.col("_size"))
        .select("doc_id", "_template", "_from", F.least("_to", F.col("_from") + 3 * F.col("_size")).alias("_to"))
    )
    spans = (
        phrases.unionByName(islands)
        .join(wanted, "_template")
        .groupBy(F.col("doc_id").alias("_hit_id"))
        .agg(F.sort_array(F.collect_set(F.struct("_from", "_to", "label", "base", "_known"))).alias("_spans"))
    )
    ids = broadcast_within(spans.select("_hit_id"), BROADCAST_ROWS)
    found = (
        texts.join(ids, F.col("doc_id").eqNullSafe(F.col("_hit_id")), "left_semi")
        .join(spans, F.col("doc_id").eqNullSafe(F.col("_hit_id")))
        .select("_hit_id", "_spans", item_words(F.col("text")).alias("_words"))
        .select(
            "_hit_id",
            F.transform(
                "_spans",
                lambda s: s.withField("words", F.slice("_words", s["_from"] + 1, s["_to"] - s["_from"])),
            ).alias("_spans"),
        )
        .groupBy("_hit_id")
        .agg(F.array_distinct(F.flatten(F.collect_list("_spans"))).alias("_spans"))
        .select("_hit_id", F.pandas_udf(_verify, FOUND)("_spans").alias("_f"))
        .select("_hit_id", "_f.*")
    )
    return (
        counts.join(found, F.col("doc_id").eqNullSafe(F.col("_hit_id")), "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
            "first_word",
            "last_word",
            F.coalesce("base_labels", F.lit("")).alias("base_labels"),
            F.coalesce("labels", F.lit("")).alias("labels"),
            F.coalesce("score", F.lit(0.0)).alias("score"),
            F.coalesce("spans", F.array().cast("array<struct<label:string,start:int,end:int,score:double>>")).alias("spans"),
        )
    )


def _agreement(words: list[str], known: list[str]) -> tuple[float, int, int]:
    """Share of the template's words found in order, first such word and the place behind the last one."""
    same = SequenceMatcher(None, words, known, autojunk=False).get_matching_blocks()
    runs = [b for b in same if b.size >= min(LEAST_RUN, len(known))]
    if not runs:
        return 0.0, 0, 0
    return sum(b.size for b in runs) / len(known), runs[0].a, runs[-1].a + runs[-1].size


def _apart(found: list[tuple[float, int, int]]) -> list[tuple[float, int, int]]:
    """The best spans that do not overlap a better one."""
    kept: list[tuple[float, int, int]] = []
    for score, start, end in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
        if all(end <= a or b <= start for _, a, b in kept):
            kept.append((score, start, end))
    return kept


def _verify(spans: pd.Series) -> pd.DataFrame:
    rows = []
    for doc in spans:
        starts, base, kept = [], set(), []
        notices: dict[tuple[str, tuple[str, ...]], list[tuple[float, int, int]]] = {}
        for s in doc:
            words, known = list(s["words"]), list(s["_known"])
            if s["base"]:
                if words == known:
                    starts.append(s["_from"])
                    base.add(s["label"])
                    kept.append((s["_from"], s["_to"], s["label"], PHRASE_SCORE))
                continue
            score, start, end = _agreement(words, known)
            if score >= MIN_SCORE:
                place = (score, s["_from"] + start, s["_from"] + end)
                notices.setdefault((s["label"], tuple(known)), []).append(place)
        for (label, _), found in notices.items():
            kept += [(start, end, label, score) for score, start, end in _apart(found)]
        kept.sort()
        rows.append(
            (
                len(starts),
                min(starts, default=None),
                max(starts, default=None),
                ",".join(sorted(base)),
                ",".join(sorted({k[2] for k in kept})),
                max((k[3] for k in kept), default=0.0),
                [{"label": label, "start": a, "end": b, "score": score} for a, b, label, score in kept],
            )
        )
    out = pd.DataFrame(rows, columns=["n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])
    return out.astype({"first_word": "Int64", "last_word": "Int64"})
