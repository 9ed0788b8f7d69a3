"""Mail messages: normalization, payment amounts and the notification log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from email import message_from_bytes
from email.header import decode_header

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import to_gmt7
from ledgerloom.functions.text import clean_text, contains_words, extract_email, remove_accents, strip_symbols
from ledgerloom.operators.incremental import process_remaining
from ledgerloom.session import spread_rows, stage

PARTS = "id string, subject string, encoded boolean, sender_text string, date_text string, body_text string"


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Header fields and the decoded text and HTML parts of raw messages; attachments are skipped."""
    for batch in batches:
        rows = []
        for key, raw in zip(batch["id"], batch["raw"]):
            message = message_from_bytes(bytes(raw))
            parts = decode_header(message.get("Subject", ""))
            encoded = any(charset is not None or isinstance(text, bytes) for text, charset in parts)
            subject = "".join(_decoded(text, charset) if isinstance(text, bytes) else text for text, charset in parts)
            body = "".join(
                _decoded(part.get_payload(decode=True) or b"", part.get_content_charset())
                for part in message.walk()
                if not part.is_multipart() and _is_text(part, message.is_multipart())
            )
            rows.append((key, subject, encoded, message.get("From"), message.get("Date"), body))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in PARTS.split(", ")])


def _decoded(content: bytes, charset: str | None) -> str:
    try:
        return content.decode(charset or "utf-8", "replace")
    except LookupError:  # a charset nobody knows
        return content.decode("utf-8", "replace")


def _is_text(part, one_of_many: bool) -> bool:
    if not one_of_many:
        return True
    attached = "attachment" in str(part.get("Content-Disposition"))
    return part.get_content_type() in ("text/plain", "text/html") and not attached


def normalize_messages(raw: DataFrame, key: str = "id", content: str = "raw") -> DataFrame:
    """Raw RFC 822 messages as (id, subject, sender, date_sent, body).

    Python only splits the MIME parts; cleaning runs as Spark expressions. Subjects that came encoded lose accents and
    symbols, plain ones stay as they are. A date of another shape is passed on unchanged.
    """
    source = raw.select(F.col(key).cast("string").alias("id"), F.col(content).cast("binary").alias("raw"))
    parts = spread_rows(source).mapInPandas(_parts, PARTS)
    subject = F.when(F.col("encoded"), strip_symbols(remove_accents(F.col("subject")))).otherwise(F.col("subject"))
    return parts.select(
        "id",
        subject.alias("subject"),
        extract_email(F.col("sender_text")).alias("sender"),
        F.coalesce(to_gmt7(F.col("date_text")), F.col("date_text")).alias("date_sent"),
        remove_accents(clean_text(F.col("body_text"))).alias("body"),
    )


@dataclass(frozen=True)
class AmountRule:
    """Patterns tried in turn on the flattened body of one sender's messages; group 1 is the amount."""

    sender: str
    patterns: tuple[str, ...]


# The senders of payment notifications and where the amount stands in their text.
PAYMENT_RULES = (
    AmountRule("alerts@citibank.com.vn", (r"VND([\d,]+)",)),
    AmountRule("info@myvib.vib.com.vn", (r"\nSo tien\s*\|\s*([\d,]+)", r"\nSo tien thanh toan\s*\|\s*([\d,]+)")),
    AmountRule("info@vib.com.vn", (r"\nGia tri: \*\*([\d,]+) VND\*\*",)),
)


def flatten_html(html: Column) -> Column:
    """HTML as plain lines: a line per block or table row, cells divided by ``|``, bold text between ``**``."""
    text = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style|head)\b.*?</\1\s*>", "")
    text = F.regexp_replace(text, r"\s+", " ")
    text = F.regexp_replace(text, r"(?i)</?(b|strong)(\s[^>]*)?>", "**")
    text = F.regexp_replace(text, r"(?i)\s*</t[dh]>\s*<t[dh](\s[^>]*)?>\s*", " | ")
    text = F.regexp_replace(text, r"(?i)\s*</?(p|div|br|tr|table|tbody|ul|ol|li|h[1-6]|hr|body|html)(\s[^>]*)?/?>\s*", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return F.concat(F.lit("\n"), F.regexp_replace(F.trim(text), r"\n[ \n]*", "\n"))


def extract_amount(sender: Column, body: Column, rules: Sequence[AmountRule] = PAYMENT_RULES) -> Column:
    """Whole amount in a payment notification; NULL for unknown senders or when no pattern fits."""
    flat = flatten_html(body)

    def first_match(pattern: str) -> Column:
        return F.nullif(F.regexp_replace(F.regexp_extract(flat, pattern, 1), ",", ""), F.lit(""))

    out: Column | None = None
    for rule in rules:
        amount = F.coalesce(*[first_match(p) for p in rule.patterns]).try_cast("long")
        out = F.when(sender == rule.sender, amount) if out is None else out.when(sender == rule.sender, amount)
    return out


def notification_log(
    messages: DataFrame,
    senders: Sequence[str],
    newest: int | None,
    log: DataFrame | None,
    as_of: dt.datetime,
    rules: Sequence[AmountRule] = PAYMENT_RULES,
) -> DataFrame:
    """New log rows for the newest n messages (by number) that come from the given senders and are not logged yet."""
    number = F.col("id").try_cast("long")
    chosen = messages if newest is None else messages.orderBy(number.desc_nulls_last(), F.col("id").desc()).limit(newest)

    def amounts(remaining: DataFrame) -> DataFrame:
        wanted = remaining.where(F.col("sender").isin(*senders))
        return wanted.select(
            "id", "subject", "sender", "date_sent", extract_amount(F.col("sender"), F.col("body"), rules).alias("amount")
        )

    return process_remaining(chosen, log, amounts, "id", as_of, [number, F.col("id")])


def keyword_flag(texts: DataFrame, owner: str, text: str, words: Sequence[str], name: str) -> DataFrame:
    """Per owner: does any text contain any of the words?"""
    return texts.groupBy(owner).agg(F.bool_or(contains_words(F.col(text), words)).alias(name))


INSIDE, OUTSIDE = r"\w", r"\W"  # what word borders part: ASCII letters, digits and _; written as ranges the JVM takes ten times as long

# Letters that differ from these in lower case only, and a pattern that texts without them seldom fit.
VARIANTS, LETTERS = "µςϐϑϕϖϰϱϵẛᲀᲁᲂᲃᲄᲅᲆᲇᲈͅι", "μσβθφπκρεṡвдосттъѣꙋιι"
VARIED = r"[\xB5\x{345}-\x{1FBE}]"

WINDOW = 3  # runs


def _folded(texts: DataFrame, name: str) -> DataFrame:
    """Text in lower case, one letter for its variants."""
    lowered = texts.withColumn(name, F.lower(name))
    return lowered.withColumn(name, F.when(F.col(name).rlike(VARIED), F.translate(name, VARIANTS, LETTERS)).otherwise(F.col(name)))


def _windows(token: bool, runs: int) -> str:
    """Pattern whose group 1 is so many whole runs, tokens and what parts them in turn, the first a token or not. A window
    begins at every run of its kind; each is read twice at most, and nothing is tried again from within a token."""
    run = [f"{c}++" for c in ((INSIDE, OUTSIDE) if token else (OUTSIDE, INSIDE))] * 2
    start, end = f"(?<!{INSIDE})" if token else f"(?<={INSIDE})", f"(?={INSIDE})" if token == (runs % 2 == 0) else ""
    window = f"({''.join(run[:runs])}){end}"
    return start + (window if runs < WINDOW else f"(?={window}){run[0]}{run[1]}")


def keyword_flags(texts: DataFrame, owner: str, text: str, words: DataFrame, name: str) -> DataFrame:
    """As :func:`keyword_flag`, with the words in a table (``word``) of any size.

    Word borders at both ends leave a word only whole runs of the text: tokens and what stands between two of them. Texts
    are cut into windows of one to three runs, of the kinds that the words are of, and meet the words by an equality join,
    which settles all of up to three runs. A longer word is filed under its longest window of two tokens, and texts that
    hold it are searched for the word. Null and empty words find nothing.
    """
    spark = texts.sparkSession
    known = _folded(words.select("word").where("word <> ''"), "word").union(spark.range(1).select(F.lit("")))  # "" stands for any text
    runs = F.size(F.regexp_extract_all("word", F.lit(f"{INSIDE}+|{OUTSIDE}+"), F.lit(0)))
    known = stage(known.distinct().select("word", runs.alias("runs"), F.col("word").rlike(f"^{INSIDE}").alias("token")), "words")
    kinds = {(k.token, k.runs) for k in known.select("token", F.least("runs", F.lit(WINDOW + 1)).alias("runs")).distinct().collect()}
    longer = any(runs > WINDOW for _, runs in kinds)

    own = _folded(texts.select(F.col(owner).alias("owner"), F.col(text).alias("text")), "text")
    own = stage(own, "texts") if longer else own  # then read twice more
    windows = lambda token, runs, c="text": F.regexp_extract_all(c, F.lit(_windows(token, runs)), F.lit(1))
    held = [F.coalesce(windows(*k), F.array().cast("array<string>")) for k in sorted(kinds) if 1 <= k[1] <= WINDOW]
    met = own.select("owner", F.col("text").isNotNull().alias("any"), F.array_distinct(F.concat(F.array(F.lit("")), *held)).alias("held"))
    # (explode would have every window cut twice more, by the filter that the planner infers from it)
    found = met.select("owner", "any", F.explode_outer("held").alias("word")).join(known.where(F.col("runs") <= WINDOW).select("word"), "word")
    flags = found.select("owner", F.when(F.col("word") != "", True).when(F.col("any"), False).alias("flag"))
    if longer:
        longest = F.get(F.array_sort(windows(True, WINDOW, "word"), lambda a, b: F.length(b) - F.length(a)), F.lit(0))
        filed = known.where(F.col("runs") > WINDOW).select("word", longest.alias("window"))
        keyed = own.where("text IS NOT NULL").withColumn("text_key", F.md5("text"))
        maybe = keyed.select("text_key", F.array_distinct(windows(True, WINDOW)).alias("held")).select("text_key", F.explode_outer("held").alias("window"))
        maybe = maybe.join(filed, "window").select("text_key", "word").distinct()
        side = lambda c: F.when(c.rlike(INSIDE), "!").otherwise("=")
        quoted = F.regexp_replace("word", r"([^0-9A-Za-z_\x80-\x{10FFFF}])", r"\\$1")
        before, after = side(F.substring("word", 1, 1)), side(F.substring(F.col("word"), F.lit(-1), F.lit(1)))
        pattern = F.concat(F.lit("(?<"), before, F.lit(INSIDE + ")"), quoted, F.lit("(?"), after, F.lit(INSIDE + ")"))
        verified = maybe.join(keyed, "text_key").where(F.contains("text", "word") & F.rlike("text", pattern))
        flags = flags.union(verified.select("owner", F.lit(True)))
    return flags.groupBy("owner").agg(F.bool_or("flag").alias("flag")).select(F.col("owner").alias(owner), F.col("flag").alias(name))
