import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars int"


def odd_texts():
    """Nulls, empty and very long texts, repeats, ties, control strings, personal data."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(400)}" for _ in range(60_000)]
    prose = " ".join(words[:300])
    return [
        None,
        "",
        " \n\t ",
        "one",
        "ONE",
        prose,
        prose,
        prose.replace("w7", "v7"),
        prose + "\n" + prose,
        " ".join(words),
        "x" * 50_000,
        "1" * 20_000 + "." + "a" * 20_000 + "@" + "b." * 10_000,
        "MIT License. Apache License, General Public License mit license",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3",
        "mail a.b@c.de, ip 10.0.0.1 or 300.1.1.1 1.2.3.4.5.6.7.8, card 4111 1111 1111 1111 and 4111111111111112",
        "call +49 (30) 1234-5678 now, a@b.c@d.e, IBAN DE89 3704 0044 0532 0130 00, ssn 123-45-6789",
        "İstanbul ΣΑΣ café ＡＢＣ   x y \x1cq <|endoftext|> <|ENDOFTEXT|> don't 's 3rd",
        "日本語のテキスト 😀 emoji 👩‍👩‍👧",
    ]


@pytest.fixture(scope="session")
def odd_rows():
    rows = [(n * 7, text, "en" if n % 3 else None, f"s{n % 2}", 0) for n, text in enumerate(odd_texts())]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    # Columns named like the operators' own, and repeated rows in number.
    frame = spark.createDataFrame(odd_rows, DOC).selectExpr("*", "1 AS item_id", "'z' AS score", "2L AS n_words")
    return frame.repartition(3)


@pytest.fixture(scope="session")
def small(spark):
    folder = "/root/testdata/sf0.001"
    return {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark", "labels", "conversations")}


@pytest.fixture(scope="session")
def small_docs(small):
    return [(r[0], r[1]) for r in small["documents"].select("doc_id", "text").collect()]
