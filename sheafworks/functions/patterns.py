"""Character sets, patterns and limits that decide which text is kept.

All of them must stay as they are for results to agree with data prepared earlier.
"""

# Characters removed by strip() and treated as word breaks.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as the inside of a regex character class (Java and RE2 both read it).
WHITESPACE_CLASS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The same without the newline.
INLINE_SPACE_CLASS = (
    r"\t\x0b-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

HTML_TAG = r"<[^>]+>"
MARKDOWN_IMAGE = r"!\[[^\]]*\]\([^)]+\)"
MARKDOWN_LINK = r"\[([^\]]+)\]\([^)]+\)"
BLANK_RUN = r"\n{3,}"
SPACE_RUN = r"[ \t]{2,}|\t"
BOX_RUN = "[┌┐└┘├┤┬┴┼│─═║╔╗╚╝╠╣╦╩╬▌▐█▀▄]+"
# A range that holds all box-drawing characters above.
BOX_BLOCK = r"[\x{2500}-\x{2590}]"
SEPARATOR_LINE = r"^[-=_*─│┌┐└┘├┤┬┴┼]+\z"
SEPARATOR_CHARS = "-=_*"
URL = f"https?://[^{WHITESPACE_CLASS}]+"
WORD = f"[^{WHITESPACE_CLASS}]+"
WORD_BREAK = f"[{WHITESPACE_CLASS}]+"
FENCE = "```"
OTHER_FENCE = "~~~"
# Characters that are not printable, but for the space and the newline.
NOT_PRINTABLE = r"[\p{C}\p{Z}&&[^ \n]]"
# Text of printable characters, spaces and newlines alone; some printable ones are not listed.
PLAIN_TEXT = (
    r"\A[ -~]*+(?:[\n\x{a1}-\x{ac}\x{ae}-\x{233}\x{400}-\x{481}\x{2010}-\x{2027}\x{2500}-\x{25ff}"
    r"\x{3041}-\x{3096}\x{4e00}-\x{9fa5}]++[ -~]*+)*+\z"
)
# What stands between paragraphs of one section.
PARAGRAPH_BREAK = "  \n"
BACK_TO_TOP = "back to top"
BADGE_HOST = "img.shields.io"
REPO_FILE = r"^(.+?)_README"
RARE_LINE_END = r"[\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
ENDS_IN_LINE_END = r"[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]\z"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"

BOX_LINE_RATIO = 0.3
MIN_CHUNK_SIZE = 50
MAX_NOISE_RATIO = 0.3
MIN_NON_SEPARATOR = 20
MAX_URL_RATIO = 0.6
ENOUGH_LETTERS = (
    rf"\A(?:[-=_*{WHITESPACE_CLASS}]*+[^-=_*{WHITESPACE_CLASS}]){{{MIN_NON_SEPARATOR}}}"
)
CHUNK_SIZE = 800
CHUNK_OVERLAP = 100
MERGE_BELOW = 200
EMBEDDING_DIM = 384
EMBEDDING_BATCH = 8
WRITE_BATCH = 100
