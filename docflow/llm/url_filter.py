"""URL filters: rules, then logistic regression on hashed character n-grams of host and path. No Python on executors.

A rule fits its host and all subdomains if the path starts with the rule's path; of several the longest wins. Urls
without a rule are judged by a model: counts of hashed character n-grams (`SIZES`, of `^host/` and of the path, in `BUCKETS`
buckets) and a bias, trained by stochastic gradient descent on a small labelled table (`LABELLED`, or any table of the
columns url and block with at most `MAX_LABELLED` rows) by DataFrame functions. The model is one array of `BUCKETS` + 1 numbers.
The labels are general vocabulary, taken from no corpus; tests hold out whole hosts.

Defined results: a null url or one without `://` has empty host and path, fits no rule and is judged by the bias, which
the training holds below one half for it (allow); rules of equal length that fit one url do not occur in `RULES`, elsewhere
the later wins; a labelled row without block is left out; without any labelled row every probability is one half; repeated rows are judged alike; extra columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docflow.llm.common import table

#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
BUCKETS, SIZES, EPOCHS, RATE, MAX_LABELLED = 8192, (3, 4), 8, 2.0, 500
#: Urls are blocked from this probability: a name that tells nothing lies well below, and is allowed.
BLOCK_FROM = 0.9

#: Words of site names for the labelled table, from general vocabulary: what filter lists block (gambling, medicine by mail, counterfeits, loans,
#: adult, malware, link farms, advertising and tracking), and what they leave alone. No host of the test tables is made from them.
_BLOCKED = """
casino poker roulette jackpot slots betting bets lottery win pills meds viagra cialis pharma replica loans payday cash money crypto bitcoin adult xxx porn sex
escort webcam nude hookup spam farm links malware virus trojan phishing keygen warez ads banner popup track click free cheap prize survey
""".split()
_ALLOWED = """
library museum weather herald science nature astronomy physics history geology botany garden birds hiking mountain river ocean forest tourist train airport
council parliament court census university school teacher student language dictionary grammar translation poetry literature theatre orchestra choir painting
architecture photography film radio cooking recipes bakery vegetarian cheese books bicycle carpentry knitting furniture engineering robotics software
compiler database linux mathematics statistics medicine hospital health dentist football athletics swimming chess running kids family norvik delmora castello
brandt okafor yamada lindholm petrov moreau santos fischer rivera bibliothek rathaus zeitung mairie musique cuisine biblioteca ayuntamiento noticias cocina
""".split()
#: Words that go with both, so that they tell nothing.
_PARTNERS = "city online best my top world shop club center now daily house land plus group one".split()
_PATHS = ("/en/12", "/de/345.html", "/fr/7/", "/es/88")
_PLACES = (("www.", "net"), ("", "org"), ("m.", "com"), ("blog.", "net"), ("", "com"))


def labelled_urls(blocked: list[str] = _BLOCKED, allowed: list[str] = _ALLOWED, each: int = 4) -> list[tuple[str, int]]:
    """(url, block) in pairs: a site named by a blocked word and one by an allowed word, alike in partner, prefix, end and path.

    Every blocked word gets `each` sites, a quarter of them bare, and the allowed words are dealt to the same frames.
    """
    out = []
    for n in range(each * len(blocked)):
        k, j = n % len(blocked), n // len(blocked)
        x = _PARTNERS[(k * 7 + j * 5) % len(_PARTNERS)]
        prefix, end = _PLACES[(k + j) % len(_PLACES)]
        path = _PATHS[(k + j + k // 4) % len(_PATHS)]
        for word, block in ((blocked[k], 1), (allowed[n % len(allowed)], 0)):
            host = word if (k + j) % 4 == 0 else f"{word}-{x}" if (k + j) % 2 else f"{x}-{word}"
            out.append((f"http://{prefix}{host}.example.{end}{path}", block))
    return out


#: The labelled urls; an empty one is allowed.
LABELLED = (*labelled_urls(), ("", 0))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; empty without `://`."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3), F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def buckets(host: Column, path: Column) -> Column:
    """The buckets of all n-grams, one entry for each occurrence; the last bucket is the bias."""

    def of(text: Column, salt: int, n: int) -> Column:
        starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.lit(salt), F.substring(text, i, F.lit(n))), F.lit(BUCKETS)).cast("int"))

    marked = F.when(host != "", F.concat(F.lit("^"), host, F.lit("$"))).otherwise("")
    return F.concat(*[of(text, salt, n) for text, salt in ((marked, 1), (path, 2)) for n in SIZES], F.array(F.lit(BUCKETS)))


def train(spark: SparkSession, labelled: DataFrame | None = None) -> list[float]:
    """The weights of the buckets and the bias, learned from the columns url and block (0 or 1).

    A row's features are its bucket counts, scaled to length one, so that long urls weigh no more. The weights are a sum of the rows, each times
    its own factor, so gradient steps over the rows, in a fixed order that mixes both classes, change one factor each and need
    only the products of the rows: at most `MAX_LABELLED` squared, whatever the corpus.
    """
    if labelled is None:
        labelled = spark.createDataFrame(list(LABELLED), "url string, block int")
    if labelled.limit(MAX_LABELLED + 1).count() > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled urls")
    host, path = host_and_path(F.col("url"))
    url = F.coalesce("url", F.lit(""))
    rows = labelled.where("block is not null").select(F.row_number().over(Window.orderBy(F.xxhash64(url), url, "block")).alias("i"), F.col("block").cast("double").alias("y"), buckets(host, path).alias("b"))
    x = rows.select("i", F.explode("b").alias("k"), F.sqrt(_squares(F.col("b"))).alias("norm")).groupBy("i", "k").agg((F.count(F.lit(1)) / F.first("norm")).alias("v"))
    other = x.select(F.col("i").alias("j"), "k", F.col("v").alias("u"))
    products = x.join(other, "k").groupBy("i", "j").agg(F.sum(F.col("v") * F.col("u")).alias("p"))
    # Rows that share nothing do not occur: their product is zero. All share the bias, so none is missing.
    lines = products.groupBy("i").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "p"))), lambda e: e["p"]).alias("p"))
    gathered = lines.join(rows.select("i", "y"), "i").agg(F.array_sort(F.collect_list(F.struct("i", "y", "p"))).alias("rows"))

    def step(a, r):
        margin = F.aggregate(F.arrays_zip(a.alias("a"), r["p"].alias("p")), F.lit(0.0), lambda t, z: t + z["a"] * z["p"])
        slip = RATE * (r["y"] - 1 / (1 + F.exp(-margin)))
        return F.concat(F.slice(a, 1, r["i"] - 1), F.array(F.element_at(a, r["i"]) + slip), F.slice(a, r["i"] + 1, F.size(a)))

    start = F.transform("rows", lambda _: F.lit(0.0))
    fitted = gathered.select(F.posexplode(F.aggregate(F.sequence(F.lit(1), F.lit(EPOCHS)), start, lambda a, _: F.aggregate("rows", a, step))).alias("at", "a"))
    found = x.join(fitted, x["i"] == fitted["at"] + 1).groupBy("k").agg(F.sum(F.col("a") * F.col("v")).alias("w")).collect()
    weights = [0.0] * (BUCKETS + 1)
    for r in found:
        weights[r["k"]] = r["w"]
    return weights


def _squares(b: Column) -> Column:
    """The sum of the squared counts of an array's values: the n-th equal value in order adds 2 n - 1."""
    start = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("run"), F.lit(0.0).alias("sum"))

    def one(a, x):
        run = F.when(a["last"] == x, a["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), (a["sum"] + 2 * run - 1).alias("sum"))

    return F.aggregate(F.array_sort(b), start, one, lambda a: a["sum"])


def judge(pages: DataFrame, weights: list[float], rules=RULES, *, id_col: str = "page_id", url_col: str = "url", least: float = BLOCK_FROM) -> DataFrame:
    """Per row: id, host, path, rule, verdict, probability (of block, by the model)."""
    host, path = host_and_path(F.col(url_col))
    parts = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The last match that is applied wins, so rules go from short to long.
    for name, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, name).otherwise(verdict)
    found = parts.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("verdict"), buckets(F.col("host"), F.col("path")).alias("b"))
    # One literal of a fixed size.
    w = F.from_json(F.lit(json.dumps([float(x) for x in weights])), "array<double>")
    total = F.aggregate("b", F.lit(0.0), lambda a, k: a + F.element_at(w, k + 1))
    probability = 1 / (1 + F.exp(-total / F.sqrt(_squares(F.col("b")))))
    scored = found.select(id_col, "host", "path", "rule", "verdict", probability.alias("probability"))
    return scored.select(id_col, "host", "path", "rule", F.coalesce("verdict", F.when(F.col("probability") >= least, "block").otherwise("allow")).alias("verdict"), "probability")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return judge(table(spark, sf_dir, "pages"), train(spark)).select("page_id", "host", "path", "rule", "verdict")
