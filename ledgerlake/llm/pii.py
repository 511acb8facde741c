"""PII surrogates: each detected entity gets a keyed replacement of its own type, format, script and gender. Names are found by a title (before them, in
Chinese after them) and wherever else a text repeats such a name or a part of it; they are made in the script they are written in: Latin, Cyrillic,
Greek or Chinese.

A surrogate is drawn by a keyed permutation of the entity's own format (cycle-walking Feistel network over its variable part), so within a format
distinct entities have distinct surrogates and an entity has the same one in every document. A check over the whole corpus then finds surrogates that
equal a real entity, or one another across formats; those entities move on along their permutation until none collides.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, fresh, materialise, prepare, slices

KEY = b"change-me"
ROUNDS = 4
BROADCAST_ROWS = 500_000

# What is detected, the first kind in this order wins where two start together.
PATTERNS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9_+-]+(?:\.[A-Za-z0-9_+-]+)*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "aws_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "secret": r"(?i:(?:password|passwd|pwd|secret|token|api_?key)(?:\s?[=:]\s?)[\"']?)(?P<secret_value>(?=[A-Za-z_+/-]*\d)[A-Za-z0-9_+/-]{8,})",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: (?=[A-Z]*\d)[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "ipv4": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w+])\+\d{1,3} ?\(\d{1,4}\) ?\d{2,4}[- ]\d{3,4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ -]\d{2,4}){2,4}(?!\d)|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\w+])\+\d{1,3}[ -]\d{6,12}(?!\d)|(?<![\w+])\+\d{8,15}(?!\d)|(?<![\w-])\d{3}-\d{3}-\d{4}(?![\w-])",
    "card": r"(?<![\d-])(?:\d{16}|\d{4}(?:[ -])\d{4}(?:[ -])\d{4}(?:[ -])\d{4}|3[47]\d{13}|3[47]\d{2}[ -]\d{6}[ -]\d{5})(?![\d-])",
    "name": r"(?<!\w)(?:Mr|Mrs|Ms|Mister|Herr|Frau|Monsieur|Madame|Señora|Señor)\.? (?P<name_value>[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+(?: [A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)?)",
    "name_cyrl": r"(?<!\w)(?:[Гг]осподин|[Гг]оспожа|[Гг]-н|[Гг]-жа) (?P<name_cyrl_value>[А-ЯЁ][а-яё]+(?: [А-ЯЁ][а-яё]+)?)",
    "name_grek": r"(?<!\w)(?:[Κκ]ύριος|[Κκ]ύριο|[Κκ]υρία|[Κκ]ος|[Κκ]α)\.? (?P<name_grek_value>[Ά-Ω][ΐά-ώ]+(?: [Ά-Ω][ΐά-ώ]+)?)",
    "name_hani": r"(?P<name_hani_value>[王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗梁宋郑谢韩唐冯于董萧程曹袁邓许傅沈曾彭吕][\u4e00-\u9fff]{1,2})(?=先生|女士|小姐)",
}
# A detected entity needs one of these: texts without them are not searched.
HINT = re.compile(r"[@\d]|AKIA|ASIA|(?:Mr|Ms|Mister|Herr|Frau|Monsieur|Madame|Señor)|[Гг](?:осп|-н|-жа)|[Κκ](?:ύρι|υρία|ος|α)|先生|女士|小姐")
FINDER = re.compile("|".join(f"(?P<{k}>{p})" for k, p in PATTERNS.items()))

# Parts of invented names, so that a surrogate is no one's, by gender; family names serve both.
FEMALE = "Adela Berta Celia Dora Elena Flora Greta Hilda Irina Julia Klara Laura Maria Nora Olga Paula Rosa Sofia Tilda Vera".split()
MALE = "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Marco Nils Oskar Pablo Rolf Simon Theo Viktor".split()
FAMILY_HEADS = "Al Bar Cor Dan El Fal Gar Hol Ing Jar Kel Lin Mor Nor Or Par Ros Sel Tor Ver".split()
FAMILY_TAILS = "berg dal den feld gard hurst lin mann more ner rick sen ström ton vall wald wick win wood zon".split()
FEMALE_TITLES = {"Mrs", "Ms", "Frau", "Madame", "Señora", "госпожа", "г-жа", "κυρία", "κα", "女士", "小姐"}
# By script: female and male first names, heads of family names, and their tails for women and men. Chinese: given names' characters, then family names.
CYRILLIC = (
    "Агата Белла Вера Галина Дина Ева Жанна Зоя Инна Клара Лада Майя Нина Ольга Полина Римма Софья Тамара Ульяна Яна".split(), "Антон Борис Вадим Глеб Денис Егор Захар Игорь Кирилл Лев Марк Назар Олег Павел Роман Семён Тарас Фёдор Юрий Яков".split(),
    "Бар Вал Гор Дар Ел Жар Зим Кал Лос Мор Нев Ор Пол Рад Сол Тур Ур Фад Хар Шер".split(), "ова ева ина ская инская енкова акова ыкова ушина янова".split(), "ов ев ин ский инский енков аков ыков ушин янов".split(),
)
GREEK = (
    "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ηρώ Θεοδώρα Ιωάννα Κλειώ Λυδία Μαρία Νεφέλη Ξένια Ουρανία Ράνια Σοφία Τατιάνα Φωτεινή Χρύσα".split(), "Άρης Βασίλης Γιάννης Δήμος Ερμής Ζήσης Ηλίας Θάνος Ιάσονας Κώστας Λευτέρης Μάνος Νίκος Ορέστης Πέτρος Ρήγας Σταύρος Τάσος Φώτης Χάρης".split(),
    "Αλ Βαρ Γαλ Δημ Ελ Ζαχ Θεοδ Καλ Λαμ Μαυρ Νικ Ορ Παπ Ρεν Σταμ Τριαντ Φιλ Χατζ Ψαρ Ωρ".split(), "ίδου άκη οπούλου άτου έα ούλη ίτση άρη ιάδου έλλη".split(), "ίδης άκης όπουλος άτος έας ούλης ίτσης άρης ιάδης έλλης".split(),
)
HAN_GIVEN, HAN_FAMILY = ("芳娟敏静丽艳娜玲婷雪梅兰莉慧颖琳", "伟强磊军洋勇杰涛明超刚平辉鹏华飞"), "王李张刘陈杨赵黄周吴徐孙胡朱高林"

DIGITS, LOWER, UPPER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"


@lru_cache(maxsize=1 << 16)
def permute(key: bytes, label: str, value: int, size: int) -> int:
    """Keyed bijection of 0..size-1: a balanced Feistel network over the next even number of bits, walked until it lands inside."""
    half = max(1, -(-(size - 1).bit_length() // 2))
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for r in range(ROUNDS):
            said = hmac.new(key, f"{label}/{r}/{right}".encode(), hashlib.sha256).digest()
            left, right = right, left ^ int.from_bytes(said, "big") & mask
        value = left << half | right
        if value < size:
            return value


def _alphabet(c: str, hexes: bool) -> str | None:
    if hexes and c in HEX:
        return HEX
    return DIGITS if c in DIGITS else LOWER if c in LOWER else UPPER if c in UPPER else None


def _same_shape(key: bytes, kind: str, text: str, steps: int, hexes: bool = False) -> str:
    """Another text of the same shape: digits stay digits, letters keep their case, all else stays."""
    sets = [_alphabet(c, hexes) for c in text]
    shape = "".join(c if s is None else s[0] for c, s in zip(text, sets, strict=True)) + f"/{kind}/{hexes}"
    size = value = 0
    for c, s in zip(text, sets, strict=True):
        if s:
            size = (size or 1) * len(s)
            value = value * len(s) + s.index(c)
    if size < 2:
        return text
    for _ in range(steps + 1):
        value = permute(key, shape, value, size)
    out = []
    for c, s in zip(reversed(text), reversed(sets), strict=True):
        if s:
            value, k = divmod(value, len(s))
            c = s[k]
        out.append(c)
    return "".join(reversed(out))


def luhn_digit(digits: str) -> str:
    """The digit that makes digits + it pass the Luhn check."""
    total = sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return str(-total % 10)


def is_luhn(digits: str) -> bool:
    return luhn_digit(digits[:-1]) == digits[-1]


def canonical(kind: str, text: str) -> str:
    """What makes two mentions the same entity."""
    if kind == "email":
        return text.lower()
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"\D", "", text)
    return text.replace(" ", "") if kind == "iban" else text


def surrogate(kind: str, text: str, steps: int = 0, key: bytes = KEY) -> str:
    """The replacement of a canonical entity; each further step is the next along its permutation."""
    if kind == "email":
        local, _, host = text.rpartition("@")
        return f"{_same_shape(key, kind + '@' + host, local, steps)}@{host.translate(str.maketrans('', '', DIGITS)).split('.', 1)[0] or 'mail'}.{_tag(key, host)}.invalid"
    if kind == "ipv4":
        value = int.from_bytes(bytes(map(int, text.split("."))), "big")
        for _ in range(steps + 1):
            value = permute(key, kind, value, 1 << 32)
        return ".".join(map(str, value.to_bytes(4, "big")))
    if kind == "card":  # the issuer's first digit and the check digit's rule stay
        body = text[0] + _same_shape(key, kind, text[1:-1], steps)
        good = luhn_digit(body)
        return body + (good if is_luhn(text) else str((int(good) + 1 + int(text[-1]) % 9) % 10))
    if kind == "phone":
        return text[:1] + _same_shape(key, kind + text[:1], text[1:], steps)
    if kind == "aws_key":
        return text[:4] + _mixed(key, kind, text[4:], steps)
    if kind == "iban":
        return text[:2] + _same_shape(key, kind + text[:2], text[2:], steps)
    if kind == "secret":
        return _same_shape(key, kind, text, steps, hexes=re.fullmatch(r"[0-9a-f]+", text) is not None)
    if kind in ("name_f", "name_m"):
        return _name(key, text, steps, kind == "name_f")
    return _same_shape(key, kind, text, steps)


def _tag(key: bytes, host: str) -> str:
    """A label for a mail host; 60 bits keep hosts apart."""
    return "h" + hmac.new(key, host.encode(), hashlib.sha256).hexdigest()[:15]


def _mixed(key: bytes, kind: str, text: str, steps: int) -> str:
    """Capital letters and digits as one alphabet."""
    letters = DIGITS + UPPER
    value = 0
    for c in text:
        value = value * 36 + letters.index(c)
    for _ in range(steps + 1):
        value = permute(key, f"{kind}{len(text)}", value, 36 ** len(text))
    out = ""
    for _ in text:
        value, k = divmod(value, 36)
        out = letters[k] + out
    return out


def _name(key: bytes, text: str, steps: int, female: bool) -> str:
    """First and family name (or family name alone) by a keyed hash, in the script of text; the check over the corpus keeps them apart."""
    said = int.from_bytes(hmac.new(key, f"name/{female}/{steps}/{text}".encode(), hashlib.sha256).digest(), "big")
    if "\u4e00" <= text[0] <= "\u9fff":
        given, said = HAN_GIVEN[not female], said // 16
        return HAN_FAMILY[said % 16] + "".join(given[said // 16**k % 16] for k in range(1, max(1 + min(steps, 3), len(text) - 1) + 1))
    if text[0] >= "\u0370":
        first, second, heads, *tails = CYRILLIC if text[0] >= "\u0400" else GREEK
        name, said = (first if female else second)[said % 20], said // 20
        family, said = heads[said % 20], said // 20
        for _ in range(2 * min(2, steps)):
            family, said = family + heads[said % 20].lower(), said // 20
        family += tails[not female][said % 10]
        return f"{name} {family}" if " " in text else family
    first, said = (FEMALE if female else MALE)[said % 20], said // 20
    family = FAMILY_HEADS[said % 20] + FAMILY_TAILS[said // 20 % 20]
    for _ in range(2 * min(2, steps)):  # longer names once the short ones collide
        said //= 401
        family += FAMILY_TAILS[said % 20]
    return f"{first} {family}" if " " in text else family


def _iban_end(text: str, start: int, end: int) -> int:
    """Where an IBAN in groups ends: groups of capitals may follow it, so the checksum decides; start where it is none."""
    for at in [end, *[start + m.start() for m in reversed([*re.finditer(" ", text[start:end])])]]:
        code = text[start:at].replace(" ", "")
        if len(code) >= 15 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
            return at
    code = text[start:end].replace(" ", "")
    return end if len(code) >= 15 and sum(c in DIGITS for c in code[4:]) >= 8 else start


def _titled(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of what the patterns find, from left to right; names are name_f or name_m by their title."""
    at = 0
    while m := FINDER.search(text, at):
        kind, at = m.lastgroup, m.end()
        inner = f"{kind}_value"
        start, end = m.span(inner if inner in FINDER.groupindex else kind)
        if kind == "card" and not is_luhn(re.sub(r"\D", "", m[kind])):
            continue
        if kind == "iban" and " " in m[kind]:
            end = at = _iban_end(text, start, end)
            if end == start:
                at = start + 4
                continue
        if kind.startswith("name"):
            title = text[end : end + 2] if kind == "name_hani" else re.split(r"[. ]", m[kind])[0]
            kind = "name_f" if title in FEMALE_TITLES or title.lower() in FEMALE_TITLES else "name_m"
        yield kind, start, end


def find(text: str | None) -> Iterator[tuple[str, int, int, str, int | None]]:
    """(kind, start, end, entity, part) of each mention of a text, from left to right.

    A name found after a title counts in the whole text: its bare mentions, and its first (part 0) or family name (part 1) alone, are mentions of
    that person. A part that several persons share is the first one's; after a title it is that of a person of this gender."""
    if not text or not HINT.search(text):
        return
    spans = [(k, a, b, canonical(k, text[a:b]), None) for k, a, b in _titled(text)]
    named = list(dict.fromkeys((k, e) for k, _, _, e, _ in spans if k in ("name_f", "name_m")))
    if not named:
        yield from spans
        return
    whole = [(k, e) for k, e in named if " " in e]
    parts: dict[tuple[str, str], tuple[str, str, int | None]] = {}  # by gender
    for part in (1, 0):
        for k, e in whole:
            parts.setdefault((k, e.split(" ")[part]), (k, e, part))
    who: dict[str, tuple[str, str, int | None]] = {}
    for k, e in whole:
        who.setdefault(e, (k, e, None))
    for (_, e), person in parts.items():
        who.setdefault(e, person)
    for k, e in named:
        who.setdefault(e, (k, e, None))
    longest = sorted(who, key=len, reverse=True)
    spaced, dense = ("|".join(re.escape(e) for e in longest if ("\u4e00" <= e[0] <= "\u9fff") is han) for han in (False, True))  # Chinese has no word ends
    bare = re.compile("|".join(x for x in (spaced and rf"(?<!\w)(?:{spaced})(?!\w)", dense) if x))
    at = 0
    for k, a, b, e, _ in [*spans, ("", len(text), len(text), "", None)]:
        for m in bare.finditer(text, at, a):
            kind, entity, part = who[m[0]]
            yield kind, *m.span(), entity, part
        if k:
            kind, entity, part = parts.get((k, e), (k, e, None))
            yield kind, a, b, entity, part
        at = b


def refit(kind: str, mention: str, new: str) -> str:
    """Put a canonical surrogate into the format of a mention: its separators and its case."""
    if kind == "iban":
        signs = iter(new)
        return "".join(c if c == " " else next(signs) for c in mention)
    if kind in ("phone", "card", "ssn"):
        digits = iter(new)
        return "".join(next(digits) if c in DIGITS else c for c in mention)
    if kind == "email" and mention.isupper():
        return new.upper()
    return new


def replace(text: str | None, choose: Callable[[str, str], str]) -> tuple[str | None, int]:
    """(text with its entities replaced, how many)."""
    out, at, n = [], 0, 0
    for kind, a, b, entity, part in find(text):
        new = choose(kind, entity)
        out += [text[at:a], refit(kind, text[a:b], new if part is None else new.split(" ")[part])]
        at, n = b, n + 1
    return (text, 0) if not n else ("".join([*out, text[at:]]), n)


def _entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, kind, entity), once for each batch and row number."""
    for batch in slices(batches, "text"):
        rows = sorted({(i, k, e) for i, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) for k, _, _, e, _ in find(t)})
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), *[pa.array([r[k] for r in rows], pa.string()) for k in (1, 2)]], names=["row", "kind", "entity"])


def mentions(docs: DataFrame, row, text_col: str = "text") -> DataFrame:
    """row, kind, entity of the texts of docs."""
    prepare(docs.sparkSession)
    return docs.select(row.cast("long").alias("row"), F.col(text_col).alias("text")).mapInArrow(_entities, "row bigint, kind string, entity string")


def collisions(found: DataFrame, key: bytes = KEY, rounds: int = 30) -> DataFrame:
    """kind, entity, steps of the entities (columns kind, entity) whose first surrogate collides.

    Of several entities with one surrogate that with the fewest steps keeps it, then the smallest; whoever has a surrogate that is itself an entity
    of the corpus moves on. All distinct entities take part."""

    @F.pandas_udf(T.StringType())
    def draw(kinds: pd.Series, entities: pd.Series, steps: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, e, s, key) for k, e, s in zip(kinds, entities, steps, strict=True)], dtype=object)

    real = materialise(found.groupBy("kind", "entity").agg(F.lit(0).alias("steps")), "entities")
    state, before = real, None
    for _ in range(rounds):
        drawn = materialise(state.withColumn("new", draw("kind", "entity", "steps")), "surrogates")
        if before is not None:
            discard(before)
        before = drawn
        taken = drawn.groupBy("new").agg(F.min(F.struct("steps", "entity", "kind")).alias("first"), F.count("*").alias("n"))
        clash = taken.join(real.select(F.col("entity").alias("new"), F.lit(True).alias("real")).distinct(), "new", "left").where("n > 1 or real")
        bad = drawn.join(clash, "new").where("real or first.entity <> entity or first.kind <> kind").select("kind", "entity", F.lit(1).alias("bad"))
        if not bad.limit(1).count():
            discard(real)
            return drawn.where("steps > 0").select("kind", "entity", "steps")
        state = drawn.join(bad, ["kind", "entity"], "left").select("kind", "entity", (F.col("steps") + F.coalesce("bad", F.lit(0))).alias("steps"))
    raise RuntimeError("surrogates still collide")


def _rewriter(key: bytes, moved):
    """(text, moves of its row) -> struct<text, n>."""

    @F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("n", T.IntegerType())]))
    def rewrite(texts: pd.Series, moves: pd.Series) -> pd.DataFrame:
        common, out = moved.value, []
        for text, own in zip(texts, moves, strict=True):
            steps = {(m["kind"], m["entity"]): m["steps"] for m in own} if own is not None else common
            out.append(replace(text, lambda k, e, steps=steps: surrogate(k, e, steps.get((k, e), 0), key)))
        return pd.DataFrame({"text": pd.Series([t for t, _ in out], dtype=object), "n": pd.Series([n for _, n in out], dtype="int32")})

    return rewrite


def with_surrogates(docs: DataFrame, *, key: bytes = KEY, text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, str]:
    """docs with a further struct column (its name is the second value): text, the rewritten text, and n, the number of replaced mentions.

    Null and empty texts stay as they are with n = 0; repeated rows, ids and other columns are untouched. Up to broadcast_rows moved entities
    are told to every task; beyond that each row is joined with its own."""
    spark, out, own = docs.sparkSession, fresh(docs, "rewritten"), fresh(docs, "moves")
    moved = collisions(mentions(docs, F.lit(0), text_col), key)
    kind = "array<struct<kind:string,entity:string,steps:int>>"
    if moved.limit(broadcast_rows + 1).count() <= broadcast_rows:
        common = spark.sparkContext.broadcast({(r["kind"], r["entity"]): r["steps"] for r in moved.collect()})
        return docs.withColumn(out, _rewriter(key, common)(F.col(text_col), F.lit(None).cast(kind))), out
    row = fresh(docs, "row")
    tagged = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "tagged")
    mine = mentions(tagged, F.col(row), text_col).join(moved, ["kind", "entity"]).groupBy(F.col("row").alias(row)).agg(F.collect_list(F.struct("kind", "entity", "steps")).alias(own))
    joined = tagged.join(mine, row, "left")
    return joined.withColumn(out, _rewriter(key, spark.sparkContext.broadcast({}))(F.col(text_col), F.col(own))).drop(row, own), out


def replace_pii(docs: DataFrame, *, key: bytes = KEY, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, text with surrogates, n_entities of every row."""
    frame, out = with_surrogates(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), key=key, broadcast_rows=broadcast_rows)
    return frame.select("doc_id", F.col(out)["text"].alias("text"), F.col(out)["n"].alias("n_entities"))


def redact(docs: DataFrame, *, key: bytes = KEY, text_col: str = "text") -> DataFrame:
    """docs, all columns as they are, with surrogates in the text."""
    frame, out = with_surrogates(docs, key=key, text_col=text_col)
    return frame.select(*[F.col(out)["text"].alias(c) if c == text_col else c for c in docs.columns])
