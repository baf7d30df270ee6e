"""Text cleaning as column expressions: each takes a string column and gives one, and stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import folds

Cleaner = Callable[[Column], Column]
CJK = "\\u4e00-\\u9fff"
#: White space as Unicode has it, and the four separators.
SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
PAGE_NUMBER = [r"^\s*第\s*\d+\s*页\s*$", r"^\s*\d+\s*/\s*\d+\s*$", r"^\s*-?\s*\d+\s*-?\s*$", r"^\s*Page\s*\d+\s*$"]
NOTICES = [r"Copyright\s+", "All rights reserved", "版权所有"]
WATERMARKS = ("copyright", "email", "www.", "西安交通大学", "xianjiaotonguniversity")
#: Headings (lower-case parts of them) of sections that are left out.
SKIP = ("前言", "思考题", "目录", "习题", "参考文献", "图书在版编目", "目 录", "目 次", "acknowledgements", "conference papers", "table of contents", "list of figures", "list of tables", "例题", "magnetism")


def sub(pattern: str, to: str = "") -> Cleaner:
    return lambda t: F.regexp_replace(t, pattern, to)


def strip(t: Column) -> Column:
    return F.btrim(t, F.lit(SPACE))


def rstrip(t: Column) -> Column:
    return F.rtrim(t, F.lit(SPACE))


def lines(t: Column) -> Column:
    return F.split(t, "\n", -1)


def keep_lines(test: Callable[[Column], Column]) -> Cleaner:
    return lambda t: F.array_join(F.filter(lines(t), test), "\n")


def compose(*cleaners: Cleaner) -> Cleaner:
    """One cleaner from many, applied from left to right; a user's own functions fit as well."""
    return lambda t: reduce(lambda c, f: f(c), cleaners, t)


strip_tags = sub("<[^>]+>")
strip_urls = sub(r"(?U)https?://\S+")
strip_emails = sub(r"(?U)[\w.-]+@[\w.-]+\.\w+")
strip_images = sub(r"!\[.*?\]\(.*?\)")
strip_code_blocks = sub(r"```[\s\S]*?```")
keep_known_chars = sub(r"[^\x20-\x7E一-鿿　-〿＀-￯\n\r\t]")
squeeze_spaces = compose(sub(r"(?U)[^\S\n]+", " "), sub("\n{3,}", "\n\n"), strip)
drop_blank_lines = keep_lines(lambda x: strip(x) != "")
fix_mojibake = compose(*(lambda t, bad=bad: F.replace(t, F.lit(bad)) for bad in ("锟斤拷", "烫烫烫", "屯屯屯", "�")))


def one_space(keep_newlines: bool = True) -> Cleaner:
    return sub(r"(?U)[^\S\n]+" if keep_newlines else r"(?U)\s+", " ")


def strip_links(keep_text: bool = True) -> Cleaner:
    return sub(r"\[([^\]]+)\]\([^\)]+\)", "$1") if keep_text else sub(r"\[.*?\]\(.*?\)")


def drop_page_numbers(t: Column) -> Column:
    return keep_lines(lambda x: ~reduce(lambda a, b: a | b, (x.rlike("(?U)" + p) for p in PAGE_NUMBER)))(t)


def drop_notices(patterns: list[str] | None = None) -> Cleaner:
    return keep_lines(lambda x: ~x.rlike("(?iuU)" + "|".join(patterns or NOTICES)))


def drop_short_lines(least: int = 5) -> Cleaner:
    return keep_lines(lambda x: F.length(strip(x)) >= least)


def drop_contents(t: Column) -> Column:
    """Drops a table of contents: its heading and the numbered or bracketed lines that follow it."""
    return folds.without_contents(t)


def drop_comments(language: str) -> Cleaner:
    if language == "python":
        return compose(sub(r"(?m)#.*$"), sub(r'"""[\s\S]*?"""'), sub(r"'''[\s\S]*?'''"))
    if language in ("java", "javascript", "c", "cpp"):
        return compose(sub(r"(?m)//.*$"), sub(r"/\*[\s\S]*?\*/"))
    return lambda t: t


def drop_imports(language: str) -> Cleaner:
    return compose(sub(r"(?m)^import .+$"), sub(r"(?m)^from .+ import .+$")) if language == "python" else lambda t: t


def tidy_lines(t: Column) -> Column:
    return F.array_join(F.filter(F.transform(lines(t), lambda x: strip(F.regexp_replace(x, "[ \t]+", " "))), lambda x: x != ""), "\n")


clean_page = compose(strip_tags, strip_urls, tidy_lines)
clean_page_and_mail = compose(strip_tags, strip_urls, sub(r"(?U)[\w.+-]+@[\w-]+\.[\w.-]+"), tidy_lines)
PRESETS: dict[str, Cleaner] = {
    "file": compose(fix_mojibake, keep_known_chars, strip_tags, strip_urls, squeeze_spaces),
    "folder": compose(fix_mojibake, keep_known_chars, squeeze_spaces),
    "markdown": compose(strip_images, strip_links(), drop_contents, squeeze_spaces),
    "code": compose(),
    "page": clean_page,
    "page_and_mail": clean_page_and_mail,
}

# of single lines
strip_brackets = sub(r"\[.*?\]")
strip_author_year = sub(rf"(?U)\b[\w{CJK}]+(?:和[\w{CJK}]+)?\s*[（(]\d{{4}}(?:[，,]\d{{4}})*[）)]")
strip_et_al = sub(r"\((?:[A-Za-z]|[一-龥])+\s+et\s+al\.,\s+\d{4}\)")
keep_line_chars = sub(r"[^\x20-\x7E一-龥　-〿＀-￯]")
strip_tail_page = compose(sub(r"[/\s]*\(\s*\d{1,4}\s*\)\s*$"), sub(r"[/\s]+\d{1,4}\s*$"))
def where_any(words: tuple[str, ...], cleaner: Cleaner) -> Cleaner:
    """*cleaner*, only for texts that hold one of *words*."""
    return lambda t: F.when(reduce(lambda a, b: a | b, (t.contains(w) for w in words)), cleaner(t)).otherwise(t)


strip_figures = compose(*(where_any((w,), sub(rf"{w}\s?\d+[.\d\-]*")) for w in ("表", "图")), *(sub(rf"(?i){w}\s?\d+[.\d\-]*") for w in ("table", "figure")))
_NUMBER = r"\d+(?:[.\-]\d+)*[A-Za-z]?"
strip_references = compose(
    where_any(("图", "表"), sub(rf"(?:参见|如|见)?\s*[图表]\s*{_NUMBER}\s*(?:所[示列给])?")),
    sub(rf"(?i)(?:as\s+shown\s+in|see)?\s*(?:fig(?:ure|\.)?|table)\s+{_NUMBER}"),
)


def is_link(x: Column) -> Column:
    return F.ltrim(x).startswith("![") | x.contains("](")


def has_watermark(x: Column, words: tuple[str, ...] = WATERMARKS) -> Column:
    return F.lower(x).rlike("|".join(f"\\Q{w}\\E" for w in words)) if words else F.lit(False)


def is_catalogue_entry(x: Column) -> Column:
    return x.contains("图书在版编目") | x.contains("CIP")


def is_contents_line(x: Column) -> Column:
    numbered = (F.size(F.regexp_extract_all(x, F.lit(r"(\d+\.\d+(?:\.\d+)*)"), 1)) >= 2) & x.rlike(r"[/\s]\d{1,4}")
    chapter = x.rlike(r"^#?\s*第(?:\d+|[一二三四五六七八九十百])章.*?[/\s]+\d{1,4}\s*$")
    return numbered | chapter | x.rlike(r"^\d+(?:\.\d+)+.*?(?:[/\s]+\d{1,4}|\(\d{1,4}\))\s*$")


def drop_contents_block(ls: Column) -> Column:
    """Of lines: a contents heading opens a block that a blank or # line closes; the block goes."""
    return folds.without_contents_block(ls)


strip_watermark = sub(r"(?iuU)西安\s*交通\s*大学\s*XIANJIAOTONGUNIVERSITY")


def is_url_line(x: Column) -> Column:
    return strip(x).rlike(r"(?U)^https?://\S+$")


def map_lines(ls: Column, cleaner: Cleaner) -> Column:
    return F.filter(F.transform(ls, lambda x: strip(cleaner(x))), lambda x: x != "")


def markdown_lines(t: Column, watermarks: tuple[str, ...] = WATERMARKS, references: bool = True, garbled: bool = True) -> Column:
    """Lines of a markdown text without contents, links, watermarks, citations, references and odd characters."""
    return folds.markdown_lines(t, watermarks=tuple(watermarks), references=references, garbled=garbled)


def plain_lines(t: Column, watermarks: tuple[str, ...] = WATERMARKS, mend: bool = True) -> Column:
    """Lines of a plain text, cleaned likewise (one blank line stays of several), with broken lines mended on request."""
    return folds.plain_lines(t, watermarks=tuple(watermarks), mend=mend)


def mend_lines(ls: Column) -> Column:
    """Joins a line that doesn't end a sentence with the next one, by pairs; headings and blanks aren't appended."""
    return folds.mended(ls)


def sentences(t: Column, space: str = SPACE) -> Column:
    """Parts of *t* up to an end mark each, without the white space (characters of *space*) before them; blank ones go."""
    blank = f"[{space}]"
    return F.filter(F.split(F.regexp_replace(t, f"^{blank}+", ""), f"(?<=[。！？.!?;；]){blank}*", -1), lambda x: x != "")


def normal_key(t: Column) -> Column:
    """Digest that ignores case and white space."""
    return F.md5(F.lower(F.regexp_replace(t, r"(?U)[\s\x1c-\x1f]+", "")))
