"""URL filters: many regular-expression rules, of which only a few run on a URL.

Each rule names literal tokens (runs of a-z and 0-9 between other characters) that every URL it
fits must hold. The rule is indexed by the one of them that is rarest in the URLs at hand. A
URL's tokens fetch its candidate rules by a join, and only their expressions run. Equal host and
path are judged once, so a hot URL costs one row; token counts combine map-side.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.attach import attach
from ..session import written
from .text import ascii_lower


@dataclass(frozen=True)
class Rule:
    """A pattern over host + path; `rank` puts kinds in order: a higher one wins, then the longer name."""

    name: str
    pattern: str
    literals: tuple[str, ...]
    verdict: str
    rank: int = 0

    def __post_init__(self):
        if not self.literals:
            raise ValueError(f"rule {self.name!r} names no literal token, so no URL can fetch it")


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains where the path starts with `path`."""
    escaped = "".join(c if c.isalnum() or c in "/-_" else f"\\{c}" for c in host + path)
    # the end of the path may cut a word, so that piece is no token of the URL
    whole = (host + path).rstrip("abcdefghijklmnopqrstuvwxyz0123456789") if path else host
    tokens = tuple(t for t in "".join(c if c.isascii() and c.isalnum() else " " for c in whole.lower()).split())
    return Rule(host + path, f"^([^/]*\\.)?{escaped}", tokens, verdict, rank=1)


HOST_RULES = (
    host_rule("block", "net", "/"),
    host_rule("allow", "example.net", "/en/"),
    host_rule("block", "example.com", "/de/"),
    host_rule("allow", "org", "/fr/"),
)
# verdicts where no host rule fits: advertising, spam and phishing names in the host or path
PATTERN_RULES = (
    Rule("casino", r"^([^/]*[.-])?(online-)?casino[.-]", ("casino",), "block"),
    Rule("pills", r"^([^/]*\.)?(cheap|discount|generic)-pills[.-]", ("pills",), "block"),
    Rule("bets", r"^([^/]*\.)?free-bets[.-]", ("free", "bets"), "block"),
    Rule("spam", r"^([^/]*\.)?spam-[^/.]+\.", ("spam",), "block"),
    Rule("ads", r"^([^/]*\.)?ads-(track|click|serve)[^/.]*\.", ("ads",), "block"),
    Rule("affiliate", r"/affiliate/(click|redirect)", ("affiliate",), "block"),
    Rule("login bait", r"^[^/]*(secure|account)-login\.", ("login",), "block"),
)
DEFAULT_VERDICT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for NULL and for a URL without ://."""
    rest = F.coalesce(F.regexp_extract(url, "(?s)://(.*)$", 1), F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(r.name).alias("name"), F.lit(r.pattern).alias("pattern"), F.lit(r.verdict).alias("verdict"),
            F.lit(r.rank).alias("rank"), F.array(*[F.lit(t) for t in r.literals]).alias("literals"),
        )
        for r in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _tokens(at: str) -> Column:
    return F.array_distinct(F.split(ascii_lower(F.col(at)), "[^a-z0-9]+"))


def index(rules: DataFrame, places: DataFrame) -> DataFrame:
    """name, pattern, verdict, rank and the token that fetches the rule: its rarest in `places`, ties by name."""
    literals = rules.select("name", F.explode("literals").alias("token"))
    counted = attach(
        places.select(F.explode(_tokens("place")).alias("token")), literals.select("token").distinct(), ["token"], how="inner"
    ).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        literals.join(counted, "token", "left")
        .groupBy("name")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("least"))
        .select("name", F.col("least.token").alias("token"))
    )
    return rules.join(rarest, "name").drop("literals")


def fitting(places: DataFrame, rules: DataFrame) -> DataFrame:
    """For each place with a fitting rule the winner: place, name, verdict, rank."""
    fetched = attach(
        places.select("place", F.explode(_tokens("place")).alias("token")), index(rules, places), ["token"], how="inner"
    )
    fits = fetched.filter(F.expr("place rlike pattern"))
    order = F.struct("rank", F.length("name").alias("length"), "name", "verdict")
    return fits.groupBy("place").agg(F.max(order).alias("best")).select("place", "best.name", "best.verdict", "best.rank")


def judged_urls(pages: DataFrame, rules: Sequence[Rule] = HOST_RULES + PATTERN_RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, pattern of every row of `pages`.

    `rule` is the host rule that decides, `pattern` the pattern rule that does, each NULL otherwise.
    NULL or malformed URLs have empty host and path and the default verdict; repeated rows are
    judged alike. An empty table gives an empty result.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("place", F.concat("host", "path"))
    places = written(rows.select("place").distinct(), "places")
    best = written(fitting(places, rule_table(pages.sparkSession, rules)), "url-rules")
    n, letters = best.agg(F.count(F.lit(1)), F.sum(F.length("place"))).first()
    # a place counts by its length, so that long URLs are not broadcast for being few
    width = len(best.columns) + (letters or 0) // (8 * max(n, 1))
    joined = attach(rows, best, ["place"], width=width, computed=True)
    return joined.select(
        "page_id", "host", "path",
        F.when(F.col("rank") > 0, F.col("name")).alias("rule"),
        F.coalesce("verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"),
        F.when(F.col("rank") == 0, F.col("name")).alias("pattern"),
    )


def allowed_pages(pages: DataFrame, rules: Sequence[Rule] = HOST_RULES + PATTERN_RULES) -> DataFrame:
    """page_id of the rows whose verdict is allow."""
    return judged_urls(pages, rules).filter("verdict = 'allow'").select("page_id")
