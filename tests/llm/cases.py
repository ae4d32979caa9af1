"""Small tables with the awkward cases that every operator must settle."""

LONG = " ".join(f"word{i} alpha beta," for i in range(4000)) + "."
TEXTS = [
    None, "", " ", "\n\n", "one", "The quick brown fox jumps over the lazy dog near the river bank.",
    "The quick brown fox jumps over the lazy dog near the river bank.",
    "Été où ça naïve façade — “quoted” ſtraße ŒUVRE.\n\nSecond\tline  with   runs \n of  space ",
    "日本語のテキスト и русский текст 😀😀 ﬁ Ⅷ ² ١٢", "it's we'll I'd they've 'tis 's 're'rest DON'T 12345 3.14 _under_score__ ",
    "a<|endoftext|>b <|endoftext|><|startoftext|> c", "x\x1cy\x1dz\x85w v u", "é é İstanbul ǅ ΣΑΣ", LONG, "A" * 3000,
]


def documents(spark, texts=TEXTS, **more):
    """Documents with repeated rows, null ids and extra columns whose names clash with helpers' names."""
    rows = [(i, t, ["en", "fr", None][i % 3], "src0" if i % 3 else None, None if t is None else len(t), 7, "x", 1.5) for i, t in enumerate(texts)]
    rows += [rows[5], (None, "text of a row without an id", None, None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, _id int, piece string, count double"
    )


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
