"""Rows that every operator must take: nulls, empty, blank, long, repeated, clashing columns."""

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Score double, entity string, part int, n_hit int"

WORDS = "the of and tion ndhaon erthwh lyered onhere wasted onand inble thonsh eaon ouwhe stlyer hatre ingnd".split()


def sentence(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 16) % len(WORDS)] + WORDS[(x >> 8) % len(WORDS)])
    return " ".join(out)


def documents(spark):
    long_text = sentence(3, 20000)
    texts = [
        (0, sentence(1, 60)),
        (1, sentence(1, 60)),  # an exact copy
        (2, sentence(1, 58) + " Changed END"),  # a near copy
        (3, None),
        (4, ""),
        (5, " \t\n"),
        (6, "one"),
        (7, "One"),
        (8, "Ünïcode façade — 日本語 テスト x"),
        (9, long_text),
        (10, sentence(5, 40)),
        (10, sentence(5, 40)),  # a repeated row
        (11, sentence(6, 40)),
        (11, sentence(7, 40)),  # a repeated id
        (None, sentence(8, 30)),
        (None, None),
        (12, "a\r\n\r\nb " * 30),
        (13, "it's <|endoftext|> don't. $$$ 3.14,15!"),
        (-5, sentence(9, 25)),
        (14, "aa " * 300),
    ]
    rows = []
    for i, (doc, text) in enumerate(texts):
        lang = [None, "en", "fr"][i % 3]
        source = [None, "s1", "s2", "s3"][i % 4]
        rows.append((doc, text, lang, source, None if text is None else len(text), 0.5, "e", i, 9))
    return spark.createDataFrame(rows, DOC_SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def rows(df, *cols):
    got = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(got, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))
