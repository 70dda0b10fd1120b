"""Small frames and plain reference versions shared by the tests of basketry.llm."""

import re

LONG = "word " * 40_000 + "end."
TEXTS = [None, "", " \n\t ", "That it.", "That  it.\n", "12 345 !?", "Ünï cödé wörds ß", "a" * 5000,
         "The same line here.\nAnother line.\nA third line.\nfour", "x\nThe same line here.\nAnother line.\nA third line.",
         "Mail jo.smith7@mail.example.com or +1 (514) 555-8389, card 4539 5787 6362 1486, ip 10.0.0.255.", LONG, LONG + " tail",
         "Released under the MIT License.\nMIT license", "That it.", "日本語 テキスト \U0001f600", "mit  LICENSE apache-license\x00x"]
CLASH = ["fp", "row_id", "score", "lang_pred", "ambiguous", "spans", "n", "key", "root", "node", "label", "covered", "split", "words", "blocks"]


def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, a null and a negative id, clashing columns."""
    rows = [(i * 3 - 5, t, ["en", None, "de"][i % 3], None if i % 2 else "s", None if t is None or i % 5 == 0 else len(t)) for i, t in enumerate(TEXTS)]
    rows += [(None, "no id here", None, None, None), (None, "That it.", "en", "s", 8), rows[3], rows[3], rows[11]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    schema += "".join(f", {c} string" for c in CLASH)
    return spark.createDataFrame([(*r, *([None] * len(CLASH))) for r in rows], schema)


def no_docs(spark):
    return odd_docs(spark).where("false")


def groups(n, linked):
    """Group of each of n items; linked: pairs."""
    up = list(range(n))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in linked:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t)


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
