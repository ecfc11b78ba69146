"""Surrogates for personal data and secrets: every entity gets a keyed replacement of its own kind and form.

Detection and replacement are expressions over the text: one pattern cuts a text into entities and what lies between.
The distinct entities of all texts form a table, which gets one surrogate each from a keyed hash of (kind, entity, try);
entities whose surrogate is also another's, or is itself an entity of the texts, try again. So equal entities get equal
surrogates in all documents and different ones get different surrogates. A form with too few members for its entities is
widened after some tries, so that the tries end.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.base import written

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# Titles by gender, and the names that stand in for given names by script and gender.
MALE = ("Mr", "Herr", "Señor", "Monsieur", "г-н")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "г-жа")
GIVEN = {
    ("latin", "male"): ("Adam", "Bruno", "David", "Emil", "Felix", "Hugo", "Jonas", "Leo", "Martin", "Oscar", "Paul", "Simon", "Thomas", "Victor"),
    ("latin", "female"): ("Alice", "Anna", "Clara", "Elena", "Emma", "Eva", "Ida", "Julia", "Laura", "Maria", "Nora", "Olga", "Sara", "Vera"),
    ("cyrillic", "male"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Иван", "Лев", "Марк", "Олег", "Павел", "Роман", "Семён"),
    ("cyrillic", "female"): ("Алла", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Лидия", "Марина", "Нина", "Ольга", "Рита", "Софья"),
}
SYLLABLES = {"latin": "bar den fal gor hel jor kas lin mor nel pol rim sol tar ven wil".split(),
             "cyrillic": "бар ден фал гор кас лин мор нел пол рим сол тар вен дол зим кор".split()}
# One part of a name: capitals inside, apostrophes (not that of a genitive) and hyphens belong to it.
NAME = r"\p{Lu}(?:[\p{L}\p{M}]|['’](?=\p{L}{2})|-(?=\p{L}))++"
PATTERNS = {
    "secret": r"""(?<![A-Za-z0-9+/_.\-])(?=[A-Za-z0-9+/_.\-]{12})(?<=(?i:token|secret|passw(?:or)?d|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key)["']?\s{0,2}[=:]\s{0,2}["']?)[A-Za-z0-9+/_.\-]{12,}+"""
              r"|(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,})(?![A-Za-z0-9])",
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}_%+][\p{L}\p{N}._%+\-]*+@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)*\.\p{L}{2,}",
    "ip": rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?\d)",
    "phone": r"(?<![\p{L}\d+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,3}(?!\d)|(?<![\p{L}\d])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\p{L}\d\-])\d{3}-\d{3}-\d{4}(?![\d\-])",
    "id": r"(?<![\p{L}\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "card": r"(?<![\p{L}\d])\d[\d \-]{11,}\d(?![\p{L}\d])",  # any run of numbers; _parts finds the cards in it
    "person": rf"(?<![\p{{L}}\d])(?=[MHFSг])(?:{'|'.join(sorted(MALE + FEMALE, key=len, reverse=True))})\.? (?:(?:{NAME}|\p{{Lu}}\.?) (?=\p{{Lu}}))*{NAME}",
}
SECRET_NAME = r"""(?i:token|secret|passw(?:or)?d|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key)["']?\s{0,2}[=:]\s{0,2}["']?"""
CARD_FORMS = ("4-4-4-4", "4-4-4-4-1", "4-4-4-4-2", "4-4-4-4-3", "4-6-5", "4-6-4")
# A text without any of these has no entity; the whole pattern is only tried on the others.
HINT = r"[0-9@]|(?i:(?:token|secret|passw(?:or)?d|pwd|key)[\"']?\s{0,2}[=:])"
WIDER = 6  # tries in the entity's own form; from then on its surrogate grows
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _luhn(digits: Column, doubled_last: bool) -> Column:
    """Sum of the digits of a number, every second one doubled from the right."""
    n, doubled = F.length(digits), F.lit(0 if doubled_last else 1)
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + _weighed(F.substring(digits, n - i, F.lit(1)).cast("int"), i % 2 == doubled))


def _weighed(d: Column, doubled: Column) -> Column:
    return F.when(doubled, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)


def kind(entity: Column) -> Column:
    """The kind of a match, null where it turns out to be none (a long number that is no card number)."""
    digits = F.regexp_replace(entity, r"\D", "")
    return (F.when(entity.rlike(f"^(?:{PATTERNS['email']})$"), "email")
            .when(entity.rlike(f"^{OCTET}(?:[.]{OCTET}){{3}}$"), "ip")
            .when(entity.rlike(f"^(?:{PATTERNS['person']})$"), "person")
            .when(entity.rlike(f"^(?:{PATTERNS['phone']})$"), "phone")
            .when(entity.rlike(f"^(?:{PATTERNS['id']})$"), "id")
            .when(entity.rlike(r"^(?:\d[ \-]?){12,18}\d$"), F.when(_luhn(digits, False) % 10 == 0, "card"))
            .otherwise("secret"))


def _with(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _parts(match: Column, before: Column) -> Column:
    """A match after the text ``before`` as (gap, entity) in order, entity null after the last: a run of numbers is tried at the borders of its numbers.

    From the left, the longest part with a valid check digit and the form of a card is one, or a telephone or identity number;
    then, where none of these is touched, the longest part of 13 to 19 digits with a valid check digit.
    """
    piece = "array<struct<gap:string,entity:string>>"

    def cut(run):
        numbers, gaps = run["numbers"], run["gaps"]
        k = F.size(numbers)

        def sizes(i):
            return F.sequence(F.least(F.lit(19), k - i), F.lit(1), F.lit(-1))

        def valid(i, n):
            digits = F.array_join(F.slice(numbers, i + 1, n), "")
            return F.length(digits).between(13, 19) & (_luhn(digits, False) % 10 == 0)

        def between(i, n):
            return F.array_distinct(F.slice(gaps, i + 2, n - 1))

        def formed(i, n):
            form = F.array_join(F.transform(F.slice(numbers, i + 1, n), lambda x: F.length(x).cast("string")), "-")
            one = F.array_join(between(i, n), "|")
            other = form.isin("3-3-4", "3-2-4") & (one == "-") & ~F.get(gaps, i).endswith("-") & ~F.get(gaps, i + n).startswith("-")
            return other | (((n == 1) | (form.isin(*CARD_FORMS) & one.isin(" ", "-"))) & valid(i, n))

        def text(i, n):
            return F.array_join(F.transform(F.sequence(i, i + n - 1), lambda x: F.concat(F.when(x > i, F.get(gaps, x)).otherwise(""), F.get(numbers, x))), "")

        def walk(forms):
            def step(a, i):
                loose = F.get(F.filter(sizes(i), lambda n: F.forall(between(i, n), lambda g: F.length(g) == 1) & valid(i, n) & F.forall(F.slice(forms, i + 1, n), lambda f: f == 0)), 0)
                return F.when(i < a["next"], a).otherwise(_with(F.when(F.get(forms, i) > 0, F.get(forms, i)).otherwise(F.coalesce(loose, F.lit(0))), lambda n: F.when(n > 0, F.struct(
                    (i + n).alias("next"), F.lit("").alias("gap"), F.concat(a["out"], F.array(F.struct(F.concat(a["gap"], F.get(gaps, i)).alias("gap"), text(i, n).alias("entity")))).alias("out"))).otherwise(
                    F.struct((i + 1).alias("next"), F.concat(a["gap"], F.get(gaps, i), F.get(numbers, i)).alias("gap"), a["out"].alias("out")))))

            start = F.struct(F.lit(0).alias("next"), F.lit("").alias("gap"), F.array().cast(piece).alias("out"))
            return F.aggregate(F.sequence(F.lit(0), k - 1), start, step, lambda a: F.concat(a["out"], F.array(F.struct(F.concat(a["gap"], F.get(gaps, k)).alias("gap"), F.lit(None).cast("string").alias("entity")))))

        return _with(F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.coalesce(F.get(F.filter(sizes(i), lambda n: formed(i, n)), 0), F.lit(0))), walk)

    run = F.struct(F.regexp_extract_all(match, F.lit(r"\d+"), F.lit(0)).alias("numbers"), F.split(match, r"\d+", -1).alias("gaps"))
    whole = F.array(F.struct(F.lit("").alias("gap"), match.alias("entity"))).cast(piece)
    return F.when(match.rlike(r"^\d[\d \-]{11,}\d$") & ~before.rlike(SECRET_NAME + "$"), _with(run, cut)).otherwise(whole)


def norms(entity: Column, of: Column) -> Column:
    """What makes two entities of a kind the same, as (kind, norm): digits of numbers, letters in any case; of a person
    each given name, with its script and the title's gender, and the last name; of an e-mail address its domain and the whole."""
    title, names = F.regexp_extract(entity, r"^(\S+) ", 1), F.split(F.regexp_replace(entity, r"^\S+ ", ""), " ")
    gender = F.when(F.regexp_replace(title, r"\.$", "").isin(*FEMALE), "female").otherwise("male")
    given = F.transform(F.slice(names, 1, F.size(names) - 1), lambda x: F.struct(F.lit("given").alias("kind"), F.concat_ws("|", F.when(_script(x), "cyrillic").otherwise("latin"), gender, F.lower(x)).alias("norm")))
    one = (F.when(of == "email", F.lower(entity)).when(of.isin("phone", "id", "card"), F.regexp_replace(entity, r"\D", ""))
           .when(of == "person", F.lower(F.element_at(names, -1))).otherwise(entity))
    domain = F.array(F.struct(F.lit("domain").alias("kind"), F.lower(F.regexp_extract(entity, "@(.*)$", 1)).alias("norm")))
    return F.concat(F.when(of == "person", given).when(of == "email", domain).otherwise(F.array()), F.array(F.struct(of.alias("kind"), one.alias("norm"))))


def _pick(choices, at: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in choices]), F.pmod(at, F.lit(len(choices))).cast("int"))


def _script(text: Column) -> Column:
    return text.rlike(r"\p{IsCyrillic}")


def surrogate(of: Column, name: Column, turn: Column, key: str) -> Column:
    """The replacement in normal form of an entity in normal form."""
    seed = F.sha2(F.concat_ws("\x1f", F.lit(hashlib.sha256(key.encode()).hexdigest()), of, name, turn.cast("string")), 256)

    def at(i: Column) -> Column:
        return F.xxhash64(seed, i)

    def digits(n: Column) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.pmod(at(i), F.lit(10)).cast("string")), "")

    wider = F.greatest(turn - (WIDER - 1), F.lit(0))

    def more(n: Column) -> Column:
        return F.when(n > 0, digits(n)).otherwise("")

    def first(text: Column) -> Column:
        return F.when(wider > 0, F.pmod(at(F.lit(-1)), F.lit(10)).cast("string")).otherwise(F.substring(text, 1, 1))

    def lettered(text: Column) -> Column:
        one = F.split(text, "")
        plain_hex, upper_hex = text.rlike("^[0-9a-f]+$"), text.rlike("^[0-9A-F]+$")
        return F.array_join(F.transform(one, lambda c, i: (
            F.when(plain_hex, _pick("0123456789abcdef", at(i))).when(upper_hex, _pick("0123456789ABCDEF", at(i)))
            .when(c.rlike(r"^\d$"), F.pmod(at(i), F.lit(10)).cast("string"))
            .when(c.rlike(r"^\p{IsCyrillic}$"), _pick("абвгдеклмнопрст", at(i)))
            .when(c.rlike(r"^\p{Lu}$"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", at(i)))
            .when(c.rlike(r"^\p{L}$"), _pick("abcdefghijklmnopqrstuvwxyz", at(i))).otherwise(c))), "")

    body = F.concat(first(name), digits(F.greatest(F.length(name) - 2, F.lit(1)) + wider))
    card = F.concat(body, F.pmod(-_luhn(body, True), F.lit(10)).cast("string"))
    phone = F.concat(first(name), digits(F.greatest(F.length(name) - 1, F.lit(1)) + wider))
    octets = F.transform(F.split(name, r"\."), lambda o, i: F.when(
        (wider == 0) & (((i == 0) & (o == "10")) | ((i < 2) & name.startswith("192.168."))), o).otherwise((1 + F.pmod(at(i), F.lit(254))).cast("string")))
    email = F.concat(lettered(F.regexp_extract(name, "^(.*)@", 1)), more(turn))
    domain = F.concat(F.lit("mail"), digits(4 + turn), F.lit(".example."), F.regexp_extract(name, r"([^.]*)$", 1))

    def last(script: str) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(1), 3 + turn), lambda i: _pick(SYLLABLES[script], at(i))), "")

    # A given name comes from the fixed ones at first, then from syllables.
    listed = reduce(lambda out, k: out.when(name.startswith("|".join(k) + "|"), F.lower(_pick(GIVEN[k], at(F.lit(0))))), GIVEN, F.when(F.lit(False), F.lit("")))
    group = F.regexp_extract(name, r"^([a-z]+[|][a-z]+[|])", 1)
    given = F.concat(group, F.when(turn < 3, listed).when(group.startswith("cyrillic"), last("cyrillic")).otherwise(last("latin")))
    return (F.when(of == "email", email).when(of == "domain", domain).when(of == "ip", F.array_join(octets, ".")).when(of == "card", card).when(of == "phone", phone).when(of == "given", given)
            .when(of == "id", digits(F.length(name) + wider)).when(of == "person", F.when(_script(name), last("cyrillic")).otherwise(last("latin"))).otherwise(F.concat(lettered(name), more(turn))))


def rendered(entity: Column, of: Column, news: Column) -> Column:
    """The replacement in the form of this entity (its punctuation, its case, its title) from those of its ``norms``.
    Digits beyond those of the entity follow its last one."""
    new = F.element_at(news, -1)
    address = F.concat_ws("@", new, F.get(news, 0))
    filled = F.aggregate(F.split(entity, ""), F.struct(F.lit("").alias("s"), F.lit(1).alias("k")), lambda a, c: F.when(
        c.rlike(r"^\d$"), F.struct(F.concat(a["s"], F.substring(new, a["k"], F.lit(1))).alias("s"), (a["k"] + 1).alias("k"))).otherwise(
        F.struct(F.concat(a["s"], c).alias("s"), a["k"].alias("k"))), lambda a: F.concat(a["s"], F.substr(new, a["k"])))
    title = F.regexp_extract(entity, r"^(\S+) ", 1)
    person = F.concat_ws(" ", title, F.array_join(F.transform(news, lambda x: F.initcap(F.regexp_replace(x, ".*[|]", ""))), " "))
    return (F.when(of.isin("phone", "id", "card"), filled).when(of == "person", person)
            .when((of == "email") & (entity == F.upper(entity)), F.upper(address)).when(of == "email", address).otherwise(new))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, new) for distinct (kind, norm): different entities get different new ones, none of which is an entity."""
    state = written(entities.select("kind", "norm", F.lit(0).alias("turn")), "surrogates")
    while True:
        named = state.withColumn("new", surrogate(F.col("kind"), F.col("norm"), F.col("turn"), key))
        owner = named.groupBy("kind", "new").agg(F.min("norm").alias("owner"), F.count(F.lit(1)).alias("n"))
        real = state.select("kind", F.col("norm").alias("new"), F.lit(True).alias("real"))
        clash = owner.join(real, ["kind", "new"], "left").where("n > 1 or real")
        clash = written(clash.select("kind", "new", F.when(F.col("real"), F.lit(None)).otherwise(F.col("owner")).alias("owner")), "surrogate-clashes")
        if clash.isEmpty():
            return written(named.select("kind", "norm", "new"), "surrogates")
        tried = named.join(clash.withColumn("hit", F.lit(True)), ["kind", "new"], "left")
        again = F.col("hit") & (F.col("owner").isNull() | (F.col("owner") != F.col("norm")))
        state = written(tried.select("kind", "norm", (F.col("turn") + F.when(again, 1).otherwise(0)).alias("turn")), "surrogates")


def replace_entities(documents: DataFrame, key: str) -> DataFrame:
    """``documents`` with text replaced where it has entities, and n_replaced (occurrences) added.

    Kinds: e-mail and IPv4 addresses, telephone, card (with a valid check digit) and identity numbers, persons after a
    title, secrets after a name such as token or password or of a known form. A number keeps its punctuation, a card number its
    first digit and a valid check digit, a telephone number its first digit, a person the title and its gender, letters their script and case. Each part of a person's name before the last has a surrogate of its own by script and gender.

    Null text stays null and has n_replaced 0, as have texts without entities, which stay as they are. Every row is
    kept, also repeated ones; equal texts get equal results. An empty table gives an empty result. Columns other than
    text are carried unread; one that is named n_replaced is replaced. Addresses of one domain stay addresses of one domain. A
    surrogate that still clashes after WIDER tries gets more digits than its entity (a number also another first digit, an IP
    address any octets); one of a secret or of the name in an e-mail address does so from the first clash on.
    """
    held = documents.select(F.struct(*documents.columns).alias("_row"), F.col("text").cast("string").alias("text"))
    found = F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))
    titled = reduce(lambda a, b: a | b, [F.contains("text", F.lit(t)) for t in MALE + FEMALE])
    some = (titled | F.col("text").rlike(HINT)) & F.col("text").rlike(PATTERN)
    order = [F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in documents.columns if c != "n_replaced"]
    plain = held.where(~F.coalesce(some, F.lit(False))).select(*order, F.lit(0).cast("long").alias("n_replaced"))
    pieces = F.flatten(F.transform(F.split("text", PATTERN, -1), lambda g, i: F.concat(
        F.array(F.struct(g.alias("gap"), F.lit(None).cast("string").alias("entity"))), F.when(F.get("found", i).isNotNull(), _parts(F.get("found", i), g)).otherwise(F.array()))))
    touched = held.where(some).withColumn("found", found).withColumn("pieces", pieces).withColumn("same", F.sha2(F.col("text"), 256))
    pairs = touched.select("same", F.explode(F.array_distinct("pieces.entity")).alias("entity")).where("entity is not null").distinct()
    pairs = pairs.withColumn("kind", kind(F.col("entity"))).where("kind is not null")
    pairs = pairs.withColumn("norms", norms(F.col("entity"), F.col("kind"))).select("same", "entity", F.col("kind").alias("of"), F.posexplode("norms").alias("at", "norm"))
    pairs = written(pairs.select("same", "entity", "of", "at", "norm.kind", "norm.norm"), "entity-pairs")
    new = assign(pairs.select("kind", "norm").distinct(), key)
    news = pairs.join(new, ["kind", "norm"]).groupBy("same", "entity", "of").agg(F.sort_array(F.collect_list(F.struct("at", "new"))).alias("news"))
    named = news.select("same", F.struct("entity", rendered(F.col("entity"), F.col("of"), F.col("news.new")).alias("new")).alias("pair"))
    maps = named.groupBy("same").agg(F.map_from_entries(F.collect_list("pair")).alias("names"))
    joined = touched.join(maps, "same", "left")
    put = F.array_join(F.transform("pieces", lambda p: F.concat(p["gap"], F.coalesce(F.try_element_at("names", p["entity"]), p["entity"], F.lit("")))), "")
    count = F.size(F.filter("pieces", lambda p: F.try_element_at("names", p["entity"]).isNotNull()))
    changed = joined.withColumn("n_replaced", F.coalesce(F.when(F.col("names").isNotNull(), count), F.lit(0)).cast("long")).withColumn("text", put)
    return plain.unionByName(changed.select(*order, "n_replaced"))
