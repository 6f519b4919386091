import random

from sheafworks.functions import markdown as M
from sheafworks.functions import text as T

PIECES = [
    "# Top <a id=x>", "## Second", "### Third  ", "#### Fourth", "plain  words\there", "", "   ", "```", "```python",
    "  ``` ", "│ ─ │ ─ │", "-----", "[docs](http://x.example/a) more", "![i](u)", "# not code?", "back to top",
    "http://b badge", "﷐ marked ﷐1", "#nospace", "#\ttab header", "text　",
]


def random_texts(n, seed=3):
    rng = random.Random(seed)
    return ["\n".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def walk_lines(text):
    """(line, state after the line, is fence), one line at a time."""
    inside = False
    for line in text.split("\n"):
        fence = line.strip().startswith("```")
        inside ^= fence
        yield line, inside, fence


def test_fence_state(value):
    texts = random_texts(60)
    found = value(M.fenced_lines, texts)
    for text, rows in zip(texts, found):
        assert [(r["line"], r["in_code"], r["is_fence"]) for r in rows] == list(walk_lines(text))


def printable(line):
    return "".join(c for c in line.strip() if c.isprintable())


def paragraphs(text):
    """(headers, text) of each paragraph, one line at a time; headers are a dict by level."""
    out, lines, heads, fence = [], [], {}, ""

    def end():
        if lines:
            out.append((dict(heads), "\n".join(lines)))
            lines.clear()

    for line in map(printable, text.split("\n")):
        if fence:
            fence = "" if line.startswith(fence) else fence
        elif line.startswith("```") and line.count("```") == 1:
            fence = "```"
        elif line.startswith("~~~"):
            fence = "~~~"
        level = len(line) - len(line.lstrip("#"))
        if not fence and level in (1, 2, 3) and (len(line) == level or line[level] == " "):
            end()
            heads = {k: v for k, v in heads.items() if k < level} | {level: line[level:].strip()}
            lines.append(line)
        elif line or fence:
            lines.append(line)
        else:
            end()
    end()
    return out


def sections_by_hand(text):
    out = []
    for heads, body in paragraphs(text):
        if out and (out[-1][0] == heads or len(out[-1][0]) < len(heads) and out[-1][1].split("\n")[-1][0] == "#"):
            out[-1] = (heads, out[-1][1] + "  \n" + body)
        else:
            out.append((heads, body))
    return [(i, *(h.get(k, "") for k in (1, 2, 3)), body) for i, (h, body) in enumerate(out)]


MORE = ["~~~", "~~~ python", "````", "#", "##", "### ", "``` in line ```", "# Top", "## Second", "#tag", "zero\u200bwidth", "\x1f## x"]


def test_sections_follow_headers(value):
    rng = random.Random(5)
    texts = random_texts(80, seed=5)
    texts += ["\n".join(rng.choice(PIECES + 2 * MORE + [""] * 6) for _ in range(rng.randint(0, 30))) for _ in range(600)]
    for text, rows in zip(texts, value(M.sections, texts)):
        assert [tuple(r) for r in rows] == sections_by_hand(text), text


def test_fences_of_two_kinds_and_empty_parents(value):
    texts = [
        "# A\n\n## B\n\n### C\ntext",  # empty parents are folded into the first part with a text
        "# A\n## B\none\n## C\ntwo",
        "# A\none\n# A\ntwo",  # the same headers again
        "~~~\n# no\n```\n# no\n~~~\n# yes",
        "````\n# no\n```\n# yes",  # a longer fence ends at a shorter one
        "```\n\na\n\n```\n\nb",
        "``` x ```\n# yes",
        "#\none\n##\ntwo",  # bare headers
        "\n\none\n\n\n\ntwo  \n\n",
    ]
    found = [[tuple(r) for r in rows] for rows in value(M.sections, texts)]
    assert found == [sections_by_hand(t) for t in texts]
    assert found[0] == [(0, "A", "B", "C", "# A  \n## B  \n### C\ntext")]
    assert [r[1:] for r in found[1]] == [("A", "B", "", "# A  \n## B\none"), ("A", "C", "", "## C\ntwo")]
    assert found[2] == [(0, "A", "", "", "# A\none  \n# A\ntwo")]
    assert found[3] == [(0, "", "", "", "~~~\n# no\n```\n# no\n~~~"), (1, "yes", "", "", "# yes")]
    assert [r[1] for r in found[4]] == ["", "yes"]
    assert found[5] == [(0, "", "", "", "```\n\na\n\n```  \nb")]
    assert found[8] == [(0, "", "", "", "one  \ntwo")]


def test_clean_text_by_lines(value):
    texts = random_texts(60, seed=9)
    stripped = value(T.strip_markup, texts)
    lines = sorted({line for t in stripped for line in t.split("\n")})
    dropped = dict(zip(lines, value(T.is_dropped_line, lines)))
    for source, cleaned in zip(stripped, value(M.clean_text, texts)):
        out = []
        for line, inside, fence in walk_lines(source):
            if inside or fence:
                out.append(line.rstrip())
            elif not dropped[line]:
                out.append(" ".join(p for p in line.strip().replace("\t", " ").split(" ") if p))
        body = "\n".join(out)
        while "\n\n\n" in body:
            body = body.replace("\n\n\n", "\n\n")
        assert cleaned == body.strip()


def test_clean_text_is_stable_outside_code(value):
    texts = [t for t in random_texts(60, seed=11) if "```" not in t]
    once = value(M.clean_text, texts)
    assert value(M.clean_text, once) == once


def test_markup_in_code_can_stay(value):
    text = ["a <b>\n```\nx <y> z\n```"]
    assert value(M.clean_text, text) == ["a\n```\nx  z\n```"]
    assert value(lambda c: M.clean_text(c, markup_in_code=False), text) == ["a\n```\nx <y> z\n```"]


def test_long_lines_and_long_documents(value):
    header = "# " + "h" * 200_000 + "\ufdd0" * 50
    many = "\n".join(f"## part {i}\n" + ("word " * 20) + ("\n```\n# code\n```" if i % 3 == 0 else "") for i in range(20_000))
    (one,), (rows,) = value(M.sections, [header]), value(lambda c: M.sections(M.clean_text(c)), [many])
    assert one[0]["h1"] == "h" * 200_000 and one[0]["text"] == header[:-50]
    assert len(rows) == 20_000 and rows[-1]["h2"] == "part 19999"
    assert "\n".join(r["text"] for r in rows).count("# code") == 6667


def test_cheap_tests_change_no_character(spark):
    from pyspark.sql import functions as F

    from sheafworks.functions import markdown as M
    from sheafworks.functions import patterns as P
    from sheafworks.functions import text as T

    chars = [chr(i) for i in range(1, 0x3400) if not 0xD800 <= i < 0xE000] + ["一", "龥", "가", "﻿", "﷐", "😀", "\U000e0001"]
    texts = [t for c in chars for t in (f"a{c}b", f"{c}a\n{c}{c}b {c}\n\n{c}c", f"a {c}\nb  \n c{c} ", c)]
    texts += ["", " ", "\n", "  \n  ", "a <b> ![x](y) [z](w)", "a  b\tc", "\n\n\n\n", "[a](b", "--- -", "---", "│ a", "ab\n\n\n\nc"]
    space = f"[{P.INLINE_SPACE_CLASS}]++"

    def bare_by_regex(t):
        bare = F.regexp_replace(F.concat(F.lit("\n"), t), rf"{space}(?=\n|\z)", "")
        return F.regexp_replace(F.regexp_replace(bare, rf"\n{space}", "\n"), P.NOT_PRINTABLE, "")

    def markup_by_regex(t):
        for pattern, by in ((P.HTML_TAG, ""), (P.MARKDOWN_IMAGE, ""), (P.MARKDOWN_LINK, "$1")):
            t = F.regexp_replace(t, pattern, by)
        return t

    def pairs(t):
        yield M._bare_lines(t), bare_by_regex(t)
        yield T.strip(t), F.btrim(t, F.lit(P.WHITESPACE))
        yield T.rstrip(t), F.rtrim(t, F.lit(P.WHITESPACE))
        yield T.strip_markup(t), markup_by_regex(t)
        yield T.collapse_spaces(t), F.regexp_replace(t, P.SPACE_RUN, " ")
        yield T.collapse_blank_lines(t), F.regexp_replace(t, P.BLANK_RUN, "\n\n")
        yield T.box_runs(t), F.regexp_count(t, F.lit(P.BOX_RUN))

    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    # Null has no boxes either; a count of null is null.
    same = [F.sum((~(a.eqNullSafe(b) | F.col("t").isNull())).cast("int")) for a, b in pairs(F.col("t"))]
    assert list(df.agg(*same).first()) == [0] * 7
    plain = df.where(F.col("t").rlike(P.PLAIN_TEXT))
    assert 1_000 < plain.count() and plain.where(F.replace("t", F.lit("\n"), F.lit("")).rlike(r"[\p{C}\p{Z}&&[^ ]]")).count() == 0
    assert plain.where(F.length("t") > 1).count() > 1_000
