"""Personal data replaced by surrogates, with DataFrame functions only.

Entities are found by one pattern: mail addresses, IPv4 addresses, phone and card numbers, account
numbers (IBAN), social security numbers, access keys, secrets after their name, and names after
a title. Each distinct entity gets one surrogate, so all its mentions in all
documents change alike. Surrogates come from SHA-256 of a secret key, the kind and the entity:

- letters become letters of the same case and digits digits, other characters stay; prefixes that name the kind
  (country code, ``AKIA``, ``password=``), the last label of a mail domain and titles stay;
- mail domains, given names and surnames are replaced on their own, so what mentions share stays shared;
- IPv4 parts stay within 0-255; card numbers that satisfy the Luhn check still do;
- names are built from syllables of their script (Latin, Greek, Cyrillic, other letters by code), given names end
  by the gender that the title tells, as entities of their own.

Distinctness: characters change by a keyed permutation of all strings of a format (rounds over the two halves of a string, each
shifted by what the other one gives), so two entities of one format never meet. What is left are surrogates that are themselves an
entity, or that entities of two formats share (letters beyond a-z become a-z): all but the smallest
are drawn again with the next attempt. From attempt ``WIDER`` on formats grow by a letter per attempt, so that a format whose strings are all
taken does not end the job. Only rows with
entities are split at them and joined with the table of surrogates; all others pass through the scan.
The entity join has the entity as key and no aggregate above it, so adaptive execution can split
a frequent one.

Defined results: a null text stays null; texts without an entity stay as they are; mentions never overlap, the leftmost
and, at one place, the kind named first wins; repeated rows each give their own result. A mail address has at most 64 characters
before the @, labels of at most 63 and no more than 126 of them; longer ones are none. Names are found behind one of the titles listed only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wordloom.functions.strings import bind
from wordloom.llm.common import documents, nested, without
from wordloom.staging import stage

#: Key of the registered query; callers give their own secret.
KEY = "example key"
MAX_ATTEMPTS = 64
#: First attempt that makes a format longer.
WIDER = 3
#: Rounds of the permutation of a format; longest string that is permuted as a whole.
ROUNDS, LONG = 4, 256
_ALPHABETS = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н", "κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "κυρία"),
    "": ("Dr", "Prof"),
}
#: Kinds in order of precedence, with their patterns.
PATTERNS = {
    # Bounded and possessive, and only from the start of a run, so that a run of any length is passed in linear time.
    "mail": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@(?:[\p{L}\p{N}-]{1,63}+\.){1,126}\p{L}{2,63}+",
    "access_key": r"\bAKIA[0-9A-Z]{16}\b",
    "secret": r"\b(?i:password|passwd|pwd|secret|token|api_key|apikey)\s*[=:]\s*[\"']?[A-Za-z0-9_+/-]{8,}+",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "card": r"(?<![\w+-])\d(?:[ -]?\d){12,18}(?!\w)",
    "phone": r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\w)",
    "name": r"(?<!\p{L})(?:" + "|".join(sorted((t for ts in _TITLES.values() for t in ts), key=len, reverse=True)) + r")\.? \p{Lu}[\p{L}'’-]+(?: \p{Lu}[\p{L}'’-]+)?",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What an entity must hold; most texts are passed over by it.
_HINT = r"[@\d]|(?i:password|passwd|pwd|secret|token|api_?key)|(?<!\p{L})(?:" + "|".join(t for ts in _TITLES.values() for t in ts) + r")\.? \p{Lu}"
_SYLLABLES = {
    "latin": ("ba da fe go ha jo ke li mo na pe ru sa ti vo ze", "n s r l", "a ia e ina"),
    "greek": ("βα γα δε ζο κα λε μι νο πα ρε σι το φα χε θι ξο", "ος ης ων ας", "α η ια ω"),
    "cyrillic": ("ба га де жо ка ле ми но па ре си то фа хе ви зо", "в н р л", "а ия ова ина"),
}


def kind_of(value: Column) -> Column:
    """Kind of a found entity."""
    kind = F.lit("name")
    for name, pattern in reversed(list(PATTERNS.items())[:-1]):
        kind = F.when(F.regexp_like(value, F.lit(rf"\A(?:{pattern})\z")), name).otherwise(kind)
    return kind


def _digest(key: str, *parts: Column) -> Column:
    """128 hexadecimal digits that only the key can tell from chance."""
    whole = F.concat_ws("\u001f", F.lit(key), *parts)
    return F.concat(F.sha2(whole, 256), F.sha2(F.concat(whole, F.lit("\u001f2")), 256))


def _draw(digest: Column, i: Column) -> Column:
    """The i-th byte of a digest, which is used again beyond 64."""
    return F.conv(F.substr(digest, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _permuted(numbers: Column, radices: Column, key: str, *parts: Column) -> Column:
    """A keyed permutation of the arrays of numbers below ``radices``: equal radices, different numbers, different results."""

    def shifted(half: Column, own: Column, other: Column, round_no: int) -> Column:
        told = F.concat_ws(",", F.transform(other, lambda x: x.cast("string")))
        digest = _digest(key, F.lit(f"round {round_no}"), *parts, F.size(half).cast("string"), told)
        draws = bind(digest, lambda d: F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: _draw(d, i)))
        return bind(draws, lambda d: F.zip_with(
            F.transform(half, lambda x, i: x + F.get(d, i % 64)), own, lambda x, r: F.pmod(x, r)
        ))

    middle = (F.size(numbers) / 2).cast("int")
    halves = lambda a: [F.slice(a, F.lit(1), middle), F.slice(a, middle + 1, F.size(numbers) - middle)]
    left, right = halves(radices)

    def step(pair: Column, round_no: int) -> Column:
        if round_no % 2 == 0:
            return bind(pair, lambda p: F.struct(p["l"].alias("l"), shifted(p["r"], right, p["l"], round_no).alias("r")))
        return bind(pair, lambda p: F.struct(shifted(p["l"], left, p["r"], round_no).alias("l"), p["r"].alias("r")))

    first = halves(numbers)
    pair = F.struct(first[0].alias("l"), first[1].alias("r"))
    for i in range(ROUNDS):
        pair = step(pair, i)
    return bind(pair, lambda p: F.concat(p["l"], p["r"]))


def _turned(value: Column, digest: Column) -> Column:
    """Letters and digits moved along their alphabets, in one pass over a string of any length."""
    for i, alphabet in enumerate(_ALPHABETS):
        by = 1 + _draw(digest, F.lit(i)) % (len(alphabet) - 1)
        moved = F.concat(F.substr(F.lit(alphabet), by + 1), F.substr(F.lit(alphabet), F.lit(1), by))
        value = F.call_function("translate", value, F.lit(alphabet), moved)
    return value


def _masked(whole: Column, key: str, *parts: Column) -> Column:
    """Letters and digits replaced in kind, the rest kept; hexadecimal strings stay hexadecimal.

    Of strings over ``LONG`` characters the first ones alone are permuted, under a key that depends on all characters; the others
    are moved along their alphabets.
    """
    long = F.length(whole) > LONG
    digest = F.when(long, _digest(key, F.lit("long"), *parts, whole)).otherwise("")
    value = F.when(long, F.substring(whole, 1, LONG // 4)).otherwise(whole)
    rest = F.when(long, bind(digest, lambda d: _turned(F.substr(whole, F.lit(LONG // 4 + 1)), d))).otherwise("")
    parts = (*parts, digest)
    hexadecimal = F.regexp_like(value, F.lit(r"\A(?:[0-9a-f]{8,}|[0-9A-F]{8,})\z"))

    def of_characters(chars: Column) -> Column:
        letters = F.when(hexadecimal, 6).otherwise(26)

        def radix(c: Column) -> Column:
            other = F.when(F.regexp_like(c, F.lit(r"\p{L}")), 26).otherwise(1)
            return F.when(c.between("0", "9"), 10).when(c.between("a", "z") | c.between("A", "Z"), letters).otherwise(other)

        def number(c: Column) -> Column:
            code = F.ascii(c)
            return (
                F.when(c.between("0", "9"), code - 48).when(c.between("a", "z"), code - 97).when(c.between("A", "Z"), code - 65)
                .when(F.regexp_like(c, F.lit(r"\p{L}")), code % 26).otherwise(0)
            )

        def shown(c: Column, n: Column) -> Column:
            upper = c.between("A", "Z") | F.regexp_like(c, F.lit(r"\p{Lu}"))
            return (
                F.when(c.between("0", "9"), n.cast("string"))
                .when(~F.regexp_like(c, F.lit(r"\p{L}")), c)
                .otherwise(F.char(F.when(upper, 65).otherwise(97) + n))
            )

        changed = bind(F.transform(chars, radix), lambda r: bind(F.transform(chars, number), lambda n: _permuted(n, r, key, *parts)))
        return F.array_join(F.zip_with(chars, changed, shown), "")

    return F.when(F.length(value) > 0, F.concat(bind(F.split(value, ""), of_characters), rest)).otherwise(value)


def _widened(shown: Column, attempt: Column, digest: Column) -> Column:
    """Later attempts have more letters."""
    more = F.transform(F.sequence(F.lit(WIDER), attempt), lambda i: F.char(97 + _draw(digest, i) % 26))
    return F.when(attempt >= WIDER, F.concat(shown, F.array_join(more, ""))).otherwise(shown)


def _luhn_sum(value: Column, skip_last: bool) -> Column:
    """Luhn sum of the digits, right to left; the last digit counts as 0 with ``skip_last``."""
    digits = F.reverse(F.split(F.regexp_replace(value, r"\D", ""), ""))

    def one(c: Column, i: Column) -> Column:
        d = c.cast("int")
        d = F.when(F.lit(skip_last) & (i == 0), 0).otherwise(d)
        return F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.transform(digits, one), F.lit(0), lambda a, x: a + x)


def _name_part(token: Column, kind: Column, attempt: Column, digest: Column) -> Column:
    """A name from syllables of the token's script, ended by its gender; later attempts are longer."""
    script = F.when(F.regexp_like(token, F.lit(r"\p{IsCyrillic}")), "cyrillic").when(F.regexp_like(token, F.lit(r"\p{IsGreek}")), "greek")
    script = F.coalesce(script, F.lit("latin"))
    built = F.lit(None).cast("string")
    for name, (body, male, female) in _SYLLABLES.items():
        pools = [F.split(F.lit(p), " ") for p in (body, male, female)]
        pick = lambda pool, i: F.element_at(pool, 1 + _draw(digest, F.lit(i)) % F.size(pool))
        stem = F.concat(*[pick(pools[0], i) for i in range(4)])
        more = F.concat(*[F.when(attempt > 4 * i, pick(pools[0], 8 + i)).otherwise("") for i in range(4)])
        end = F.when(kind == "given m", pick(pools[1], 5)).when(kind == "given f", pick(pools[2], 5)).otherwise(pick(pools[0], 4))
        built = F.when(script == name, F.initcap(F.concat(stem, more, end))).otherwise(built)
    other = F.regexp_like(token, F.lit(r"\p{L}")) & ~F.regexp_like(token, F.lit(r"[\p{IsLatin}\p{IsGreek}\p{IsCyrillic}]"))
    letters = F.split(token, "")
    drawn = F.transform(letters, lambda c, i: F.when(F.regexp_like(c, F.lit(r"\p{L}")), F.element_at(letters, 1 + _draw(digest, i) % F.length(token))).otherwise(c))
    return F.when(other, F.array_join(drawn, "")).otherwise(built)


def _parts(gap: Column, value: Column) -> Column:
    """A mention as (text before, kind, value); names are given names and surnames of their own."""
    kind = kind_of(value)
    title = F.regexp_extract(value, r"\A\S+ ", 0)
    bare = F.regexp_replace(F.trim(title), r"\.\z", "")
    given = F.when(bare.isin(*_TITLES["m"]), "given m").when(bare.isin(*_TITLES["f"]), "given f").otherwise("given x")
    names = F.split(F.substr(value, F.length(title) + 1), " ")
    part = lambda before, kind, value: F.struct(before.alias("before"), kind.alias("kind"), value.alias("value"))
    surname = F.element_at(names, -1)
    return (
        F.when(kind != "name", F.array(part(gap, kind, value)))
        .when(F.size(names) > 1, F.array(part(F.concat(gap, title), given, F.element_at(names, 1)), part(F.lit(" "), F.lit("surname"), surname)))
        .otherwise(F.array(part(F.concat(gap, title), F.lit("surname"), surname)))
    )


def surrogate(value: Column, kind: Column, attempt: Column, key: str) -> Column:
    """The surrogate of an entity."""
    again = attempt.cast("string")
    own = _digest(key, kind, value, again)
    masked = lambda v: _masked(v, key, kind, again)
    at = F.instr(value, "@")
    local = F.substring(value, F.lit(1), at - 1)
    domain = F.substr(value, at + 1)
    top = F.regexp_extract(domain, r"\.\p{L}+\z", 0)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(top))
    # All mentions of a domain change alike, at any attempt.
    mail = F.concat(_widened(masked(local), attempt, own), F.lit("@"), _masked(host, key, F.lit("domain"), F.lower(top)), top)
    head = F.regexp_extract(value, r"\A\w+\s*[=:]\s*[\"']?", 0)
    secret = F.concat(head, _widened(masked(F.substr(value, F.length(head) + 1)), attempt, own))
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    radices = F.transform(octets, lambda x, i: F.when(i == 0, 223).otherwise(256))
    inside = F.transform(octets, lambda x, i: F.when(i == 0, F.pmod(x - 1, F.lit(223))).otherwise(x))
    ip = F.transform(_permuted(inside, radices, key, kind, again), lambda x, i: F.when(i == 0, x + 1).otherwise(x).cast("string"))
    plain = masked(value)
    digit = bind(plain, lambda m: F.concat(F.substring(m, F.lit(1), F.length(m) - 1), ((10 - _luhn_sum(m, True) % 10) % 10).cast("string")))
    card = F.when(_luhn_sum(value, False) % 10 == 0, digit).otherwise(plain)
    code = F.regexp_extract(value, r"\A\+\d{1,3}(?=[ .(-])", 0)
    phone = F.concat(code, _widened(masked(F.substr(value, F.length(code) + 1)), attempt, own))
    country = F.concat(F.substring(value, 1, 2), masked(F.substr(value, F.lit(3))))
    access = F.concat(F.lit("AKIA"), masked(F.substr(value, F.lit(5))))
    name = _name_part(value, kind, attempt, own)
    return (
        F.when(kind == "mail", mail).when(kind == "secret", secret).when(kind == "ip", F.array_join(ip, "."))
        .when(kind == "card", card).when(kind == "phone", phone).when(kind == "iban", _widened(country, attempt, own))
        .when(kind == "access_key", access).when(kind == "ssn", _widened(plain, attempt, own)).otherwise(name)
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate, attempt): distinct entities with distinct surrogates, none of them an entity."""
    made = surrogate(F.col("value"), F.col("kind"), F.col("attempt"), key)
    done, open_ = None, entities.select("kind", "value").withColumn("attempt", F.lit(0))
    for _ in range(MAX_ATTEMPTS):
        drawn = stage(open_.withColumn("surrogate", made), "surrogates-drawn")
        taken = drawn.groupBy("surrogate").agg(F.min(F.struct("value", "kind")).alias("owner"))
        free = drawn.join(taken, "surrogate").where("value = owner.value AND kind = owner.kind").drop("owner")
        free = free.join(entities.select(F.col("value").alias("surrogate")), "surrogate", "left_anti")
        if done is not None:
            free = free.join(done.select("surrogate"), "surrogate", "left_anti")
        free = stage(free.select("kind", "value", "surrogate", "attempt"), "surrogates-free")
        left = drawn.join(free.select("kind", "value"), ["kind", "value"], "left_anti").select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        done = free if done is None else done.unionByName(free)
        open_ = stage(left, "surrogates-open")
        if not open_.limit(1).count():
            return done
    raise ValueError(f"no distinct surrogates within {MAX_ATTEMPTS} attempts for: {open_.limit(3).collect()}")


def replace_private(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The rows with ``text`` free of the entities found, and ``n_entities``."""
    order = without(df, ["n_entities"])
    rows = df.select(nested(df, [text, "n_entities"]).alias("row"), F.col(f"`{text}`").alias("text"))
    hinted = F.coalesce(F.regexp_like("text", F.lit(_HINT)), F.lit(False))
    has = hinted & F.regexp_like("text", F.lit(ENTITY))
    found = rows.where(has).select("row", F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)).alias("values"), F.split("text", ENTITY, -1).alias("gaps"))
    parts = F.flatten(F.zip_with(F.slice("gaps", F.lit(1), F.size("values")), "values", _parts))
    found = found.select(
        "row", parts.alias("parts"), F.element_at("gaps", -1).alias("tail"), F.size("values").alias("n_entities"), F.monotonically_increasing_id().alias("number")
    )
    found = stage(found, "private-rows")  # fixes the row numbers
    mentions = found.select("number", F.posexplode(F.transform("parts", lambda p: F.struct(p.kind, p.value))).alias("at", "p")).select("number", "at", "p.*")
    entities = stage(mentions.select("kind", "value").distinct(), "private-entities")
    table = stage(surrogates(entities, key), "private-surrogates")
    new = (
        mentions.join(table.select("kind", "value", "surrogate"), ["kind", "value"]).groupBy("number")
        .agg(F.sort_array(F.collect_list(F.struct("at", "surrogate"))).alias("new"))
    )
    joined = F.zip_with("parts", "new.surrogate", lambda p, s: F.concat(p.before, s))
    changed = found.join(new, "number").select("row", F.concat(F.array_join(joined, ""), "tail").alias("text"), "n_entities")
    whole = changed.unionByName(rows.where(~has).withColumn("n_entities", F.lit(0)))
    return whole.select(*[F.col("text").alias(text) if c == text else F.col(f"row.`{c}`") for c in order], "n_entities")


def op7_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its personal data replaced."""
    return replace_private(documents(spark, folder).select("doc_id", "text"), KEY)
