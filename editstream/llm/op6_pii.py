r"""Surrogates for personal data (DataFrame and SQL functions only).

1. One pattern, run once over every text, finds emails, phone numbers (``+`` forms,
   US local ones), payment cards (with a valid check digit), IP addresses of both
   versions, IBANs, US social security numbers, access keys, assigned secrets and
   names behind a title. A possessive's ``'s`` is kept and no part of a name. A match falls into parts: kept
   ones (``password=``, ``Mrs.``) and entities with a type and a canonical form
   (lower case, or digits without separators), so spellings of one entity
   corefer, in a text and across texts.
2. Every distinct entity gets one surrogate: its characters are replaced class
   by class (digit, hex digit, upper and lower case, vowel and consonant of a
   name, Latin, Cyrillic, Greek or Armenian script) from a keyed hash. Cards keep a valid check
   digit, addresses stay in range, given names end as their gender's names do;
   separators and letter case of each spelling are kept. The domain of an
   address is an entity of its own, so that users of one domain keep one.
3. Collision checks: a surrogate that another entity of the type has, or that
   is itself an entity of the corpus, is drawn anew for all but the first, until
   none is left; distinct entities stay distinct.
4. The documents and their matches are written once. Only texts with a match are
   shuffled, one row a distinct text, and only their distinct entities are joined
   with surrogates; others pass untouched.

Defined cases: null and empty texts stay; entities of a form with few values
get a longer surrogate after several collisions (addresses freer octets); matched digits that are no valid
card stay; repeated rows get equal surrogates; ties of collisions go to the
smaller canonical form; very long texts and values go whole; a word after
``token:`` and the like is a secret only with a digit or in quotes; an empty table
gives no rows; other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .shared import read_table, stored

KEY = "surrogates-1"
LONGER_FROM = 4  # rounds of collisions after which a form may get longer

# Titles that come before names, by gender.
MALE = "Mr|Sir|Herr|Monsieur|Señor|Sr|г-н|господин".split("|")
OTHER_TITLES = "Dr|Prof|Professor".split("|")
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|г-жа|госпожа".split("|")

# Possessive quantifiers (++) have no bound and need no stack. The second form of a domain ends before labels that are none.
_MAILBOX = r"[A-Za-z0-9._%+-]++"
_DOMAIN = (r"(?:(?:[A-Za-z0-9-]++\.(?=[A-Za-z]{2}|[A-Za-z0-9-]++\.))++[A-Za-z]{2,}+"
           r"|(?:[A-Za-z0-9-]++\.){1,127}[A-Za-z]{2,}+)")
EMAIL = rf"(?<![A-Za-z0-9._%+-]){_MAILBOX}@{_DOMAIN}"
# A value of 8 characters or more up to its last that is no dot; an address after the sign is an address.
ASSIGNED = (r"(?i:\b(?:(?:password|passwd|pwd)\s{0,2}[=:]"
            r"|(?:secret|token|api[_-]?key)\s{0,2}(?:=|:(?=\s{0,2}(?:[\"']|[A-Za-z+/_.=~-]*+\d))))\s{0,2}[\"']?)"
            rf"(?!{_MAILBOX}@{_DOMAIN})"
            r"(?=[A-Za-z0-9+/_.=~-]{7,}?[A-Za-z0-9+/_=~-])(?:\.*+[A-Za-z0-9+/_=~-]++)++")
ACCESS_KEY = r"\bAKIA[0-9A-Z]{16}\b"
PHONE = r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\)|[ .-]?\d{1,4})(?:[ .-]?\d{2,4}){1,4}(?!\w)"
LOCAL_PHONE = r"(?<![\w+(.-])(?:\(\d{3}\) ?\d{3}-\d{4}|\d{3}(?:-\d{3}-|\.\d{3}\.)\d{4})(?![\w-]|\.\d)"
_GROUP = "[0-9A-Fa-f]{1,4}"
# Global, unique local and link-local addresses, whole or with one gap.
IPV6 = (r"(?<![\w:.])(?:[23][0-9A-Fa-f]{3}|[fF][cCdDeE][0-9A-Fa-f]{2})"
        rf"(?:(?::{_GROUP}){{7}}|(?::{_GROUP}){{0,5}}::(?:{_GROUP}(?::{_GROUP}){{0,5}})?)(?![\w:])")
IP = r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\w]|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
IBAN = r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"
CARD = r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])"
NAME = rf"(?<![\p{{L}}])(?:{'|'.join(MALE + FEMALE + OTHER_TITLES)})\.? \p{{Lu}}[\p{{L}}'’-]++(?: \p{{Lu}}[\p{{L}}'’-]++)?"
PATTERN = "|".join([EMAIL, ASSIGNED, ACCESS_KEY, PHONE, LOCAL_PHONE, IPV6, IP, SSN, IBAN, CARD, NAME])

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_VOWELS, _CONSONANTS = "aeiou", "bcdfghjklmnprstvwz"
_GREEK_VOWELS, _GREEK_CONSONANTS = "αεηιου", "βγδζκλμνπρστφχ"
_ARMENIAN_VOWELS, _ARMENIAN_CONSONANTS = "աեիոօ", "բգդզլկհմնպստրք"
_CYR_VOWELS, _CYR_CONSONANTS = "аеиоу", "бвгдзклмнпрст"


def _part(kind, canon, surface) -> Column:
    return F.struct(F.lit(kind).alias("kind") if isinstance(kind, str) else kind.alias("kind"),
                    canon.alias("canon"), surface.alias("surface"))


def _keep(surface) -> Column:
    return _part("", F.lit(""), surface)


def _valid_card(digits: Column) -> Column:
    """The check digit of payment cards holds."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def parts(match: Column) -> Column:
    """The kept parts and entities of a match, in order."""
    digits = F.regexp_replace(match, r"\D", "")
    lower = F.lower(match)
    assigned = r"^((?i:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?)(.*)$"
    value = F.regexp_extract(match, assigned, 2)
    name = r"^(\S+ )(\S+)(?:( )(\S+))?$"
    title, first, last = (F.regexp_extract(match, name, i) for i in (1, 2, 4))
    plain_title = F.regexp_replace(title, r"\.? $", "")
    given = (F.when(plain_title.isin(FEMALE), F.lit("given_f")).when(plain_title.isin(OTHER_TITLES), F.lit("given_x"))
             .otherwise(F.lit("given_m")))
    own = r"['’][sS]?$"  # of a possessive

    def surname(x):
        bare = F.regexp_replace(x, own, "")
        return [_part("surname", F.lower(bare), bare), _keep(F.regexp_extract(x, own, 0))]
    address, domain = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)
    return (
        F.when(match.rlike(f"^(?:{ASSIGNED})$"), F.array(
            _keep(F.regexp_extract(match, assigned, 1)), _part("secret", value, value)))
        .when(match.contains("@"), F.array(
            _part("mailbox", F.lower(address), address), _keep(F.lit("@")),
            _part("domain", F.lower(domain), domain)))
        .when(match.rlike(f"^(?:{ACCESS_KEY})$"), F.array(_part("access_key", match, match)))
        .when(match.rlike(rf"^(?:\+|{LOCAL_PHONE}$)"), F.array(_part("phone", digits, match)))
        .when(match.rlike(f"^{IPV6}$"), F.array(_part("ipv6", lower, match)))
        .when(match.rlike(f"^(?:{IP})$"), F.array(_part("ip", match, match)))
        .when(match.rlike(f"^(?:{SSN})$"), F.array(_part("ssn", digits, match)))
        .when(match.rlike(r"^[A-Z]{2}\d{2}"), F.array(_part("iban", F.regexp_replace(match, " ", ""), match)))
        .when(match.rlike(r"^\d"), F.when(_valid_card(digits), F.array(_part("card", digits, match)))
              .otherwise(F.array(_keep(match))))
        .when(F.length(last) > 0, F.array(_keep(title), _part(given, F.lower(first), first), _keep(F.lit(" ")), *surname(last)))
        .otherwise(F.array(_keep(title), *surname(first))))


def _hash(kind, canon, turn, key: str) -> Column:
    """256 hex digits of a keyed hash of an entity and the round."""
    inner = F.sha2(F.concat_ws("\u0001", F.lit(key), kind, canon, turn.cast("string")), 256)
    return F.concat(*[F.sha2(F.concat(F.lit(f"{key}\u0001{i}\u0001"), inner), 256) for i in range(4)])


def _surrogate(key: str) -> str:
    """SQL for the canonical surrogate of (kind, canon, turn, h = hash)."""
    n = "CAST(conv(substring(h, (i % 128) * 2 + 1, 2), 16, 10) AS INT)"
    pick = lambda letters: f"substring('{letters}', {n} % {len(letters)} + 1, 1)"
    longer = f"greatest(turn - {LONGER_FROM - 1}, 0)"
    # Longer by copies of the last letter or digit, a domain by letters before its first label; octets get freer instead.
    more = f"repeat(coalesce(nullif(right(regexp_replace(canon, '[^\\\\p{{L}}\\\\p{{N}}]', ''), 1), ''), 'x'), {longer})"
    padded = f"""CASE WHEN kind = 'ip' THEN canon WHEN kind = 'domain' THEN concat(repeat('x', {longer}), canon)
        WHEN kind IN ('phone', 'ssn', 'card') THEN concat(canon, repeat('0', {longer})) ELSE concat(canon, {more}) END"""
    hexed = "((kind = 'secret' AND canon RLIKE '^[0-9a-f]+$') OR (kind = 'ipv6' AND c <> ':'))"
    named = "kind IN ('surname', 'given_f', 'given_m', 'given_x')"
    by_class = f"""array_join(transform(split({padded}, ''), (c, i) -> CASE
        WHEN kind = 'access_key' AND i < 4 THEN c
        WHEN kind = 'domain' AND i >= length(canon) + {longer} - length(substring_index(canon, '.', -1)) - 1 THEN c
        WHEN kind = 'iban' AND i < 2 THEN c
        WHEN kind = 'phone' AND i = 0 THEN c
        WHEN kind = 'ipv6' AND i < 4 THEN c
        WHEN {hexed} THEN {pick('0123456789abcdef')}
        WHEN kind IN ('phone', 'card') AND i IN (0, 1, 4) AND c RLIKE '[0-9]' THEN CASE WHEN kind = 'card' AND i = 0 THEN c ELSE {pick('23456789')} END
        WHEN c RLIKE '[0-9]' THEN {pick('0123456789')}
        WHEN {named} AND c RLIKE '[aeiouyäöüáéíóúàèâêîôû]' THEN {pick(_VOWELS)}
        WHEN {named} AND c RLIKE '[a-zß-ÿ]' THEN {pick(_CONSONANTS)}
        WHEN c RLIKE '[аеёиоуыэюяєіїѣў]' THEN {pick(_CYR_VOWELS)}
        WHEN c RLIKE '[а-яѐ-ӿ]' THEN {pick(_CYR_CONSONANTS)}
        WHEN c RLIKE '[αεηιουωάέήίόύώϊϋΐΰ]' THEN {pick(_GREEK_VOWELS)}
        WHEN c RLIKE '[ά-ώ]' THEN {pick(_GREEK_CONSONANTS)}
        WHEN c RLIKE '[աեէըիոօւ]' THEN {pick(_ARMENIAN_VOWELS)}
        WHEN c RLIKE '[ա-և]' THEN {pick(_ARMENIAN_CONSONANTS)}
        WHEN c RLIKE '[a-z]' THEN {pick(_LOW)}
        WHEN c RLIKE '[A-Z]' THEN {pick(_UP)}
        WHEN c RLIKE '\\\\p{{L}}' THEN {pick(_LOW)}
        ELSE c END), '')"""
    # An octet keeps its number of digits; after some rounds any octet will do.
    n1 = n.replace("(i % 128)", "i")
    octets = f"""array_join(transform(split(canon, '[.]'), (c, i) -> CAST(CASE
        WHEN turn >= {LONGER_FROM} THEN 1 + {n1} % 254
        WHEN length(c) = 1 THEN 1 + {n1} % 9 WHEN length(c) = 2 THEN 10 + {n1} % 90
        ELSE 100 + {n1} % 155 END AS STRING)), '.')"""
    body = f"left({by_class}, length(canon) + {longer} - 1)"
    doubled = "aggregate(transform(split(reverse(body), ''), (c, i) -> CASE WHEN i % 2 = 1 THEN CAST(c AS INT) ELSE CAST(c AS INT) * 2 - CASE WHEN CAST(c AS INT) > 4 THEN 9 ELSE 0 END END), 0, (a, x) -> a + x)"
    card = f"element_at(transform(array({body}), body -> concat(body, CAST((10 - {doubled} % 10) % 10 AS STRING))), 1)"
    vowel_end = f"concat(left({by_class}, length({padded}) - 1), CASE WHEN canon RLIKE '[а-яѐ-ӿ]' THEN 'а' WHEN canon RLIKE '[ά-ώ]' THEN 'α' WHEN canon RLIKE '[ա-և]' THEN 'ա' ELSE 'a' END)"
    other_end = f"concat(left({by_class}, length({padded}) - 1), CASE WHEN canon RLIKE '[а-яѐ-ӿ]' THEN 'н' WHEN canon RLIKE '[ά-ώ]' THEN 'ς' WHEN canon RLIKE '[ա-և]' THEN 'ն' ELSE 'n' END)"
    return f"""CASE kind WHEN 'ip' THEN {octets} WHEN 'card' THEN {card}
        WHEN 'given_f' THEN {vowel_end} WHEN 'given_m' THEN {other_end} ELSE {by_class} END"""


#: The canonical surrogate ``s`` in the form of ``surface``: separators where they were, letter case letter by letter; what it is longer by at the end.
_IN_FORM = r"""CASE
  WHEN kind IN ('phone', 'card', 'ssn') THEN aggregate(split(surface, ''), named_struct('out', '', 'i', 1),
    (a, c) -> CASE WHEN c RLIKE '[0-9]' THEN named_struct('out', concat(a.out, substring(s, a.i, 1)), 'i', a.i + 1)
      ELSE named_struct('out', concat(a.out, c), 'i', a.i) END, a -> concat(a.out, substring(s, a.i)))
  WHEN kind = 'iban' THEN aggregate(split(surface, ''), named_struct('out', '', 'i', 1),
    (a, c) -> CASE WHEN c <> ' ' THEN named_struct('out', concat(a.out, substring(s, a.i, 1)), 'i', a.i + 1)
      ELSE named_struct('out', concat(a.out, c), 'i', a.i) END, a -> concat(a.out, substring(s, a.i)))
  WHEN kind IN ('mailbox', 'domain', 'surname', 'given_f', 'given_m', 'given_x') THEN array_join(transform(split(s, ''),
    (c, i) -> CASE WHEN substring(surface, i + 1, 1) <> lower(substring(surface, i + 1, 1)) THEN upper(c) ELSE c END), '')
  WHEN kind = 'ipv6' AND surface RLIKE '[A-F]' THEN upper(s)
  ELSE s END"""


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """Distinct (kind, canon) -> kind, canon, s: one surrogate each, all distinct."""
    table = stored(entities.select("kind", "canon", F.lit(0).alias("turn"))
                   .withColumn("h", _hash(F.col("kind"), F.col("canon"), F.col("turn"), key))
                   .withColumn("s", F.expr(_surrogate(key))).drop("h"), "surrogates")
    originals = table.select("kind", F.col("canon").alias("s"), F.lit(True).alias("taken"))
    while True:
        first = W.partitionBy("kind", "s").orderBy("turn", "canon")
        marked = stored(table.join(originals, ["kind", "s"], "left").withColumn(
            "bad", F.coalesce("taken", F.lit(False)) | (F.row_number().over(first) > 1)).drop("taken"), "surrogates")
        if not marked.filter("bad").limit(1).count():
            return marked.select("kind", "canon", "s")
        anew = marked.filter("bad").select("kind", "canon", (F.col("turn") + 1).alias("turn"))
        anew = anew.withColumn("h", _hash(F.col("kind"), F.col("canon"), F.col("turn"), key)).withColumn("s", F.expr(_surrogate(key)))
        table = stored(marked.filter("NOT bad").select("kind", "canon", "turn", "s").unionByName(anew.drop("h")), "surrogates")


def replace_entities(docs: DataFrame, key: str = KEY, text_col: str = "text") -> DataFrame:
    """docs with surrogates in ``text_col``; all columns and rows kept."""
    text = F.col(text_col)
    # The one search of all texts; what follows reads its matches.
    marked = stored(docs.select(F.struct(*docs.columns).alias("_d"),
                                F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)).alias("m")), "marked")
    whole = F.col("_d")[text_col]
    # A text is known by its hash: copies are resolved once.
    found = marked.filter(F.size("m") > 0).withColumn("_text", F.sha2(whole.cast("binary"), 256))
    texts = found.select("_text", "m").dropDuplicates(["_text"])
    spread = stored(texts.select("_text", F.posexplode("m").alias("i", "match")).select(
        "_text", "i", F.posexplode(parts(F.col("match"))).alias("j", "p")).select("_text", "i", "j", "p.*"), "entities")
    named = surrogates(spread.filter("kind <> ''").select("kind", "canon").distinct(), key)
    entities = spread.filter("kind <> ''").join(named, ["kind", "canon"]).select("_text", "i", "j", F.expr(_IN_FORM).alias("s"))
    kept = spread.filter("kind = ''").select("_text", "i", "j", F.col("surface").alias("s"))
    by_text = entities.union(kept).groupBy("_text").agg(F.collect_list(F.struct("i", "j", "s")).alias("_s"))
    by_text = stored(by_text, "replacements")
    between = F.transform(F.split(whole, PATTERN, -1), lambda x, i: F.struct(i.alias("i"), F.lit(-1).alias("j"), x.alias("s")))
    rebuilt = F.array_join(F.transform(F.sort_array(F.concat(between, F.col("_s"))), lambda x: x["s"]), "")
    changed = found.join(by_text, "_text").select(
        *[(rebuilt if c == text_col else F.col("_d")[c]).alias(c) for c in docs.columns])
    untouched = marked.filter(F.coalesce(F.size("m"), F.lit(0)) <= 0).select("_d.*")
    return untouched.unionByName(changed)


def op6_keyed_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with surrogates for what their texts tell of persons."""
    return replace_entities(read_table(spark, sf_dir, "documents"))
