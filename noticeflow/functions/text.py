"""Titles, teasers, hashes and rule predicates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .url import strip
from .variant import bound


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def title_fingerprint(title: Column) -> Column:
    """Lower case, letters and digits only."""
    return F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), r"[^\p{L}\p{N}]+", "")


def title_base(title: Column, words: Sequence[str] = rules.UPDATE_WORDS) -> Column:
    """The fingerprint of a title without its update words."""
    return title_fingerprint(F.regexp_replace(F.coalesce(title, F.lit("")), "|".join(words), ""))


def candidate_id(url: Column) -> Column:
    return F.concat(F.lit("C"), F.upper(F.substring(F.sha2(url, 256), 1, 12)))


def truncate(text: Column, n: int) -> Column:
    """Newlines as spaces, trimmed, and cut to n characters, the last being an ellipsis."""
    flat = strip(F.translate(F.coalesce(text, F.lit("")), "\n", " "))
    return F.when(F.length(flat) <= n, flat).otherwise(F.concat(F.substring(flat, 1, n - 1), F.lit("…")))


def teaser(summary: Column, content: Column, n: int = 240) -> Column:
    return truncate(F.coalesce(blank_to_null(summary), content), n)


def has_any(text: Column, words: Sequence[str]) -> Column:
    return F.coalesce(text.rlike(rules.FLAGS + "|".join(words)), F.lit(False))


def matches(text: Column, rule: rules.Rule) -> Column:
    return F.coalesce(text.rlike(rules.java(rule.pattern)), F.lit(False))


#: Letters that Unicode takes for i, s and k where case doesn't count, though they are no capitals of these.
_FOLDED = "\u0130\u0131\u017f\u212a", "iisk"


def folded(text: Column) -> Column:
    """A text as it is compared where case doesn't count."""
    return F.lower(F.translate(F.coalesce(text, F.lit("")), *_FOLDED))


def trie(words: Iterable[str]) -> str:
    """A pattern that matches the longest of the words that starts where it stands; each letter of a text is looked at once."""
    root: dict = {}
    for word in words:
        at = root
        for c in word:
            at = at.setdefault(c, {})
        at[""] = {}

    def of(node: dict) -> str:
        on = [rules.literal(c) + of(child) for c, child in sorted(node.items()) if c]
        if not on:
            return ""
        some = on[0] if len(on) == 1 else f"(?:{'|'.join(on)})"
        return f"(?:{some})?" if "" in node else some

    first = "".join(rules.literal(c) for c in sorted(root) if c)
    return f"(?=[{first}])(?=({of(root)}))"


class Found:
    """Which of many words a text has, case aside: the text is read once, whatever their number."""

    def __init__(self, words: Iterable[str]):
        self.words = sorted({w.lower() for w in words if w})

    def scan(self, text: Column) -> Column:
        """For each place the longest word that starts there, each once; shorter ones are the beginnings of these."""
        none = F.array().cast("array<string>")
        return F.array_distinct(F.regexp_extract_all(folded(text), F.lit(trie(self.words)), 1)) if self.words else none

    def any_of(self, found: Column, words: Iterable[str]) -> Column:
        """Whether what `scan` has found shows one of the words."""
        wanted = {w.lower() for w in words}
        shown = [x for x in self.words if any(x.startswith(w) for w in wanted)]
        return F.arrays_overlap(found, F.array(*[F.lit(x) for x in shown])) if shown else F.lit(False)


def _matching(text: Column, ordered: Sequence[rules.Rule], use) -> Column:
    """use([(rule, whether it matches)]). The hints of all rules are looked for at once; only a rule of which one is there, and that
    isn't decided by it, reads the text again by its own pattern. A rule without hints always does."""
    found = Found(h for r in ordered for h in r.hints)

    def told(seen: Column) -> Column:
        return use([(r, matches(text, r) if not r.hints else found.any_of(seen, r.hints) if r.plain else found.any_of(seen, r.hints) & matches(text, r)) for r in ordered])

    return bound(found.scan(text), told)


def first_match(text: Column, ordered: Sequence[rules.Rule]) -> Column:
    """The name of the first rule that matches, else null."""
    return _matching(text, ordered, lambda all_: F.coalesce(*[F.when(m, F.lit(r.name)) for r, m in all_], F.lit(None).cast("string")))


def all_matches(text: Column, ordered: Sequence[rules.Rule]) -> Column:
    """The names of all rules that match, in their order."""
    return _matching(text, ordered, lambda all_: F.array_compact(F.array(*[F.when(m, F.lit(r.name)) for r, m in all_])))


def words_in(text: Column, words: Sequence[str]) -> Column:
    """Those of the words that the text contains, in their order."""
    found = Found(words)
    return bound(found.scan(text), lambda seen: words_seen(text, words, found, seen))


def words_seen(text: Column, words: Sequence[str], found: Found, seen: Column) -> Column:
    """Those of the words that a scan has found and that the text has in the very same letters, in their order."""
    same = lambda w: found.any_of(seen, [w]) & F.contains(text, F.lit(w))
    return F.array_compact(F.array(*[F.when(same(w), F.lit(w)) for w in words])).cast("array<string>")


def html_title(html: Column) -> Column:
    return F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<title>(.*?)</title>", 1)


def html_text(html: Column) -> Column:
    """A page's text: no scripts, styles, comments or tags, white space as single spaces."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    return strip(F.regexp_replace(bare, r"(?U)\s+", " "))


def phones(text: Column) -> Column:
    """Phone numbers of a text in order: area code with number, or a mobile number."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PHONE), 1)


#: Tags at which a line of a page ends; the cells of a table's row are one line.
BLOCK = r"(?is)</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|section|article|header|footer|main|nav|aside|body|form|dl|hr|pre|blockquote)\b[^>]*>"
#: Words before the name of a person to ask, and the name.
CONTACT = r"(?:联\s*系\s*人|联系人姓名|经办人)\s*(?:及电话|及联系方式)?\s*[:：]?\s*([\p{IsHan}]{2,4}(?:老师|先生|女士|主任|经理)?)"
PHONE = r"(?<!\d)(0\d{2,3}-\d{7,8}(?:-\d{1,5})?|1[3-9]\d{9})(?!\d)"


def html_blocks(html: Column) -> Column:
    """A page's lines of text in order: cut at block tags, without scripts, styles, comments and other tags, none of them empty."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ")
    lines = F.transform(F.split(bare, BLOCK), lambda x: strip(F.regexp_replace(F.regexp_replace(x, r"(?s)<[^>]*>", " "), r"(?U)\s+", " ")))
    return F.filter(lines, lambda x: x != "")


def contacts(html: Column, name: str = CONTACT, phone: str = PHONE) -> Column:
    """(name, phone) that a page gives of whom to ask, the string null where there is none.

    Contacts stand at a page's end: the last line with a labelled name has it, and its number is the first from there on, else the
    last one before. Without a labelled name the page's last number counts.
    """

    def of(lines: Column) -> Column:
        each = F.transform(lines, lambda x, k: F.struct(k.alias("k"), F.regexp_extract(x, name, 1).alias("name"), F.regexp_extract_all(x, F.lit(phone), F.lit(1)).alias("phones")))
        return bound(each, found)

    def found(each: Column) -> Column:
        named, numbered = F.filter(each, lambda x: x["name"] != ""), F.filter(each, lambda x: F.size(x["phones"]) > 0)
        return bound(F.struct(F.try_element_at(named, F.lit(-1)).alias("n"), numbered.alias("p")), chosen)

    def chosen(x: Column) -> Column:
        after = F.filter(x["p"], lambda p: p["k"] >= x["n"]["k"])
        number = F.when(F.size(after) > 0, after[0]["phones"][0]).otherwise(F.try_element_at(F.try_element_at(x["p"], F.lit(-1))["phones"], F.lit(-1)))
        return F.struct(F.coalesce(x["n"]["name"], F.lit("null")).alias("name"), F.coalesce(number, F.lit("null")).alias("phone"))

    return bound(html_blocks(html), of)


def contact(html: Column) -> Column:
    """The number to call that a page gives, or the string null."""
    return contacts(html)["phone"]


def contact_name(html: Column) -> Column:
    """The person to ask that a page gives, or the string null."""
    return contacts(html)["name"]


def record_id(day: Column, key: Column) -> Column:
    """T, the day as yyyyMMdd, and six characters without 0, O, 1 and I drawn from the key's SHA-256."""
    letters = F.lit("ABCDEFGHJKLMNPQRSTUVWXYZ23456789")
    digest = F.sha2(key, 256)
    drawn = [F.substr(letters, F.pmod(F.conv(F.substring(digest, 1 + 2 * k, 2), 16, 10).cast("int"), F.lit(32)) + 1, F.lit(1)) for k in range(6)]
    return F.concat(F.lit("T"), F.date_format(day, "yyyyMMdd"), F.lit("-"), *drawn)


def is_record_id(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\AT\p{Nd}{8}-[A-HJ-NP-Z2-9]{6}\z"), F.lit(False))
