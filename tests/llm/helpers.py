"""Rows that every operator must take, and plain versions to compare with."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
# columns whose names the operators use themselves
EXTRA = ("size int, target string, copies string, row string, n_units string, class string, "
         "key string, component string, letters string, rep string, n string")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def words(text):
    return WORD.findall(text or "")


def documents(spark, rows, extra=False):
    """A table of (doc_id, text[, lang[, source]]) rows."""
    full = [(r + (None,) * 4)[:4] + (None if r[1] is None else len(r[1]),) for r in rows]
    schema = DOCUMENT
    if extra:
        schema += ", " + EXTRA
        full = [r + (1,) + ("x",) * 10 for r in full]
    return spark.createDataFrame(full, schema)


AWKWARD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (5, "Éa ñ 中文 \U0001F600 x"),
    (None, "the words of no document at all go here"), (6, "word " * 30000),
    (7, "x" * 20000), (8, "..!?..\n\n\r\n"), (9, "\u2028 a\u00a0b <|endoftext|> it's"),
]
