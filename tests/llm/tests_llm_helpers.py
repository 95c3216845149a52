"""Brute-force versions that the operators are compared with."""

import hashlib
import re

UPPER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def frame(spark, rows, columns="doc_id long, text string"):
    """A frame in several partitions."""
    return spark.createDataFrame(rows, columns).repartition(3)


#: Nulls, empty texts, texts without words, ties, repeated rows and a long text.
EDGES = [(1, None), (2, ""), (3, "?!"), (4, "one"), (5, "One, two!"), (5, "One, two!"), (None, "no id here at all, none"),
         (7, "word " * 3000), (8, "é漢🙂 " * 40), (9, "\x00\x01 a\tb\r\n"), (10, "One, two!")]
