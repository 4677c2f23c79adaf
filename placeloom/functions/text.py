"""Names, phones, domains and their similarity, as columns.

Only what Spark lacks runs in Python, batch-wise: Unicode normal forms and Jaro-Winkler.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import BRANCH, GENERIC_WORDS, LEGAL_FORMS, LETTERS, PHONE_RULES, SHARED_HOSTS, SILENT_LETTERS

_PAIRS = dict(zip(LETTERS.split()[::2], LETTERS.split()[1::2]))


def _each(f):
    """A string function as an Arrow-batched column function; null stays null."""

    def batch(s):
        return s.map(f, na_action="ignore")

    batch.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(batch, "string")


def nfkc(c: Column) -> Column:
    return _each(lambda x: unicodedata.normalize("NFKC", x))(c)


def folded(c: Column) -> Column:
    """NFKC, then case folding."""
    return _each(lambda x: unicodedata.normalize("NFKC", x).casefold())(c)


def strip_accents(c: Column) -> Column:
    return _each(lambda x: "".join(y for y in unicodedata.normalize("NFKD", x) if not unicodedata.combining(y)))(c)


def words_only(c: Column) -> Column:
    """What isn't a letter, number or white space becomes a space; runs of space collapse. Null is empty."""
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("ё"), F.lit("е"))
    c = F.regexp_replace(c, r"[^\p{L}\p{N}\s]", " ")
    return F.trim(F.regexp_replace(c, r"[\s\p{Z}]+", " "))


def normalize_text(c: Column) -> Column:
    return words_only(folded(c))


def transliterate(c: Column) -> Column:
    for a, b in _PAIRS.items():
        if len(b) > 1:
            c = F.replace(c, F.lit(a), F.lit(b))
    single = {a: b for a, b in _PAIRS.items() if len(b) == 1}
    return F.translate(c, "".join(single) + SILENT_LETTERS, "".join(single.values()))


def name_norm(c: Column) -> Column:
    return strip_accents(transliterate(normalize_text(c)))


def _latin(word: str) -> str:
    word = "".join(_PAIRS.get(x, "" if x in SILENT_LETTERS else x) for x in word)
    return "".join(y for y in unicodedata.normalize("NFKD", word) if not unicodedata.combining(y))


def _set(words) -> Column:
    return F.array(*(F.lit(w) for w in words))


def core_tokens(tokens: Column, latin: Column) -> Column:
    """Of the tokens and, place by place, their Latin forms: the Latin ones that identify, or all if none does."""
    legal, generic = _set(LEGAL_FORMS), _set(GENERIC_WORDS)
    generic_latin = _set(sorted({_latin(w) for w in GENERIC_WORDS}))
    both = F.arrays_zip(tokens.alias("t"), latin.alias("l"))
    kept = F.filter(both, lambda x: ~F.array_contains(legal, x["t"]) & ~F.array_contains(generic, x["t"]) & ~F.array_contains(legal, x["l"]) & ~F.array_contains(generic_latin, x["l"]))
    return F.when(F.size(kept) > 0, F.transform(kept, lambda x: x["l"])).otherwise(latin)


def core_name(c: Column) -> Column:
    """The part of a name that identifies: no branch numbers, legal forms or generic words, in Latin letters."""
    plain = words_only(folded(F.regexp_replace(nfkc(c), BRANCH, " ")))
    latin = strip_accents(transliterate(plain))
    return F.when(F.coalesce(plain, F.lit("")) == "", F.lit("")).otherwise(F.array_join(core_tokens(F.split(plain, " "), F.split(latin, " ")), " "))


def normalize_phone(raw: Column, country: Column | str = "KZ") -> Column:
    """E.164 at best effort; null where the number can't be read."""
    country = F.upper(F.lit(country) if isinstance(country, str) else country)
    raw = F.trim(raw)
    digits = F.regexp_replace(raw, "[^0-9]", "")
    n = F.length(digits)
    national = F.when(digits.startswith("0"), F.substring(digits, 2, 40)).otherwise(digits)
    foreign = F.when(raw.startswith("00"), F.substring(digits, 3, 40)).otherwise(digits)
    out = F.when(F.coalesce(digits, F.lit("")) == "", None).when(raw.startswith("+") | raw.startswith("00"), F.when(F.length(foreign).between(8, 15), F.concat(F.lit("+"), foreign)))
    for iso2, (code, lengths) in PHONE_RULES.items():
        own = F.lit(None).cast("string")
        own = F.when(F.length(national).isin(*lengths), F.concat(F.lit("+" + code), national)).otherwise(own)
        own = F.when(digits.startswith(code) & (n - len(code)).isin(*lengths), F.concat(F.lit("+"), digits)).otherwise(own)
        if code == "7":
            own = F.when((n == 11) & F.substring(digits, 1, 1).isin("7", "8"), F.concat(F.lit("+7"), F.substring(digits, 2, 10))).otherwise(own)
        if code == "1":
            own = F.when((n == 11) & digits.startswith("1"), F.concat(F.lit("+"), digits)).otherwise(own)
        out = out.when(country == iso2, own)
    return out


def normalize_domain(url: Column) -> Column:
    """Lower-case host without a leading www; null for shared hosts and what isn't a host."""
    url = F.trim(url)
    full = F.when(F.contains(url, F.lit("://")), url).otherwise(F.concat(F.lit("http://"), url))
    place = F.regexp_extract(full, r"^[^/?#]*://([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(place, r"^.*@", ""), r":[^:]*$", ""))
    bare = F.when(host.startswith("www."), F.substr(host, F.lit(5))).otherwise(host)
    shared = bare.isin(*SHARED_HOSTS)
    for h in SHARED_HOSTS:
        shared = shared | bare.endswith("." + h)
    return F.when(F.contains(host, F.lit(".")) & ~shared, bare)


def token_set_similarity(a: Column, b: Column) -> Column:
    """Shared distinct words over those of the smaller side; 0 if a side has none."""
    parts = lambda c: F.array_distinct(F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda w: w != ""))
    x, y = parts(a), parts(b)
    least = F.least(F.size(x), F.size(y))
    return F.when(least > 0, F.size(F.array_intersect(x, y)) / least).otherwise(F.lit(0.0))


def jaro_winkler_of(a: str, b: str, scale: float = 0.1) -> float:
    """Jaro with half the transpositions, unrounded, and the prefix bonus at any similarity."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free, mine = list(range(len(b))), []
    theirs: list[int] = []
    for i, ch in enumerate(a):
        hit = next((j for j in free if abs(i - j) <= reach and b[j] == ch), None)
        if hit is not None:
            free.remove(hit)
            mine.append(ch)
            theirs.append(hit)
    m = len(mine)
    if not m:
        return 0.0
    swapped = sum(x != b[j] for x, j in zip(mine, sorted(theirs)))
    jaro = (m / len(a) + m / len(b) + (m - swapped / 2) / m) / 3
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return jaro + prefix * scale * (1 - jaro)


def jaro_winkler(a: Column, b: Column) -> Column:
    def batch(a, b):
        return pd.Series([jaro_winkler_of(x or "", y or "") for x, y in zip(a, b)], dtype="float64")

    batch.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    return F.pandas_udf(batch, "double")(a, b)


def name_similarity(a: Column, b: Column) -> Column:
    """The larger of both similarities of core names; 0 if one is empty."""
    some = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")
    return F.when(some, F.greatest(jaro_winkler(a, b), token_set_similarity(a, b))).otherwise(F.lit(0.0))


def content_hash(*fields: Column) -> Column:
    """SHA-1 over the fields as a JSON list, nulls kept apart from empty ones."""
    return F.sha1(F.to_json(F.array(*(F.coalesce(f.cast("string"), F.lit("\0")) for f in fields))))


def flat_hash(*fields: Column) -> Column:
    """MD5 over the fields joined by a bar; nulls are skipped, as the city profile has it."""
    return F.md5(F.concat_ws("|", *fields))


def name_uuid(namespace: str, name: Column) -> Column:
    """A version 5 UUID: SHA-1 over namespace and name, with version and variant set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), 1, 4)
    third = F.concat(F.lit("5"), F.substring(h, 14, 3))
    nibble = F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4
    fourth = F.concat(F.substr(variant, nibble + 1, F.lit(1)), F.substring(h, 18, 3))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), third, fourth, F.substring(h, 21, 12))


def job_key(iso2: Column, kind: Column, source: Column, version: Column, pipeline: Column) -> Column:
    return F.concat_ws(":", F.upper(iso2), kind, F.coalesce(source, F.lit("-")), F.coalesce(version, F.lit("-")), pipeline)
