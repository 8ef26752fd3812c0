"""URL filters: host and path rules, and a classifier on character n-grams for the rest.

The classifier is logistic regression on hashed n-grams of host and path, trained from a small table
of labelled URLs. Only built-in functions and Spark's own learner are used.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules in use.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
BUCKETS = 1 << 15
# Sizes of grams and the penalty are those of least loss in nine folds of the labelled table alone.
GRAMS = (1, 3)
PENALTY = 0.0025
MAX_RULES = 1000

# The labelled table: URLs to block, then URLs to let through. Kinds of sites in general: gambling,
# pharmacies, loans, adult, pirated and counterfeit goods, phishing, swindles, advertising networks and
# link sellers, against the many kinds of ordinary pages, some of them with hyphens.
BLOCKED_URLS = """
http://poker-bonus.example.com/en/31
https://www.slots-jackpot.example.org/play
http://m.roulette-online.example.com/fr/77.html
https://lotto-prizes.example.info/claim
http://blackjack-vip.example.net/es/541#top
https://www.bingo-millions.example.com/de/88.html
http://viagra-online.example.com/en/6
https://meds-discount.example.biz/order
http://m.pharmacy-express.example.org/fr/415
https://weight-loss-miracle.example.info/buy
http://steroids-shop.example.com/en/12/
https://payday-loans.example.biz/apply
http://quick-cash.example.com/en/55?ref=x
https://debt-relief.example.org/offer
http://www.easy-credit.example.com/es/9
https://hot-singles.example.info/join
http://xxx-videos.example.com/de/4
https://live-cams.example.net/en/71
http://mature-dating.example.com/fr/1203
https://torrent-cracks.example.org/download
http://warez-download.example.com/en/803
https://movie-streams.example.info/watch
http://keygen-serials.example.com/en/20#top
https://replica-watches.example.biz/sale
http://designer-outlet.example.com/es/33
https://www.luxury-handbags.example.org/fr/700
http://paypal-verify.example.com/login
https://secure-update.example.net/account
http://bank-confirm.example.com/en/9?session=1
https://apple-unlock.example.info/id
http://m.wallet-recovery.example.com/en/16
https://bitcoin-doubler.example.com/en/3
http://crypto-giveaway.example.org/de/14
https://forex-signals.example.com/fr/28
http://instant-millionaire.example.com/en/95.html
https://popunder-network.example.net/serve
http://click-redirect.example.com/en/410
https://banner-exchange.example.org/show
http://pixel-beacon.example.com/fr/6
https://affiliate-clicks.example.com/es/84
http://push-notify.example.info/subscribe
https://link-exchange.example.org/en/17
http://backlinks-seo.example.com/de/62
https://doorway-pages.example.com/en/240
http://traffic-boost.example.net/buy
https://m.article-spinner.example.com/en/7
http://buy-followers.example.org/es/50
https://virus-warning.example.com/call
http://flash-update.example.com/en/37
https://pc-cleaner.example.org/fr/19
http://survey-rewards.example.com/en/2?page=2
https://lucky-draw.example.com/de/6
http://voucher-claim.example.net/en/48
https://miracle-cure.example.com/es/11
http://viagra24.example.biz/en/3
https://xxxtube.example.com/fr/77
http://bonus777.example.com/en/8
https://mp3crack.example.info/download
https://loan4u.example.org/apply
http://m.pokerking.example.com/en/640
""".split()
ALLOWED_URLS = """
http://www.library.example.org/en/221/
https://m.university.example.com/de/103#top
https://blog.gardening.example.com/fr/658
http://astronomy.example.com/es/187139
https://harvest.example.org/en/198609
http://blog.carpentry.example.com/en/21155
https://www.orchestra.example.org/en/173709
http://m.seashore.example.com/fr/168978?page=2
https://library.example.org/catalogue/books/12
https://www.faculty.example.edu/physics/lectures/3.html
http://news.example.com/2021/04/12/city-council-vote
https://museum.example.org/collections/paintings
https://docs.example.io/guide/install.html
http://wiki.example.org/wiki/River
https://recipes.example.com/soups/tomato
http://weather.example.net/forecast/today
https://garden-club.example.org/roses
http://school.example.edu/timetable
https://travel-notes.example.com/es/valencia
http://forum.example.org/thread/9921?page=4
https://archive.example.org/details/letters
http://city.example.gov/permits/form.html
https://journal.example.org/volume/7/issue/2
http://music-theory.example.com/chords
https://chess-club.example.org/results
https://film-reviews.example.com/en/1999
https://history-society.example.org/articles/81
http://city-council.example.gov/minutes
https://bird-watching.example.org/en/12
https://birds.example.org/fr/oiseaux
http://www.bakery.example.de/de/brot.html
https://science-blog.example.com/posts/soil
http://maps.example.org/trails/42
https://shop.example.com/en/teapots
http://code.example.org/projects/parser
https://health.example.gov/vaccines/children
https://cinema.example.com/en/1999
http://poems.example.org/es/sonetos
https://blog.meadow.example.org/de/239796
http://lantern.example.net/en/141956
https://m.winter.example.org/es/123920.html
http://www.theatre.example.com/en/65?page=2&ref=x
https://eastern.example.com/en/4033.html
http://blog.northern.example.org/fr/9311/
https://weather.example.com/de/5989#top
http://m.teacher.example.com/en/1291/
https://www.history.example.net/es/7442.html
http://mountain.example.org/en/7205?utm_source=feed
https://blog.feather.example.com/en/7617/
http://season.example.com/fr/7376#top
https://m.stories.example.org/de/3413
https://thunder.example.com/en/80117
http://www.aventure.example.com/fr/52
https://blog.estacion.example.org/es/9940
http://m.wanderung.example.com/de/71
https://lecture.example.org/en/6/
http://translation.example.com/fr/818.html
https://parenting.example.org/en/44?page=2
http://www.handwerk.example.com/de/2017
mailto:editor@example.org
readme.html
""".split()


@dataclass
class UrlFilter:
    """Rules and a fitted classifier; make one with ``fit``."""

    rules: tuple[Rule, ...]
    model: LogisticRegressionModel
    tf: HashingTF
    grams: tuple[int, ...]
    threshold: float = 0.5

    def judge(self, pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
        """``id_col``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` of each row.

        Null urls and those without ``://`` have empty host and path: no rule fits them and the
        classifier judges an empty string. Repeated rows are judged alike; other columns ignored. An empty
        table gives no rows; a very long url has as many grams as characters, held by one row.
        """
        parts = pages.select(F.col(id_col), *url_parts(F.col(url_col)))
        scored = self._scored(parts)
        rule = self._rule(F.col("host"), F.col("path"))
        own = F.when(F.col("score") >= self.threshold, "block").otherwise("allow")
        return scored.withColumn("__rule", rule).select(
            id_col,
            "host",
            "path",
            F.col("__rule.name").alias("rule"),
            F.coalesce("__rule.verdict", own).alias("verdict"),
            "score",
        )

    def _rule(self, host: Column, path: Column) -> Column:
        """The longest rule that fits, null if none."""
        cases = F.lit(None).cast("struct<name:string,verdict:string>")
        for r in sorted(self.rules, key=lambda r: (len(r.name), r.name)):
            fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
            named = F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))
            cases = F.when(fits, named).otherwise(cases)
        return cases

    def _scored(self, parts: DataFrame) -> DataFrame:
        found = self.tf.transform(with_grams(parts, self.grams))
        scored = self.model.transform(found)
        return scored.withColumn("score", vector_to_array("__probability")[1]).select(
            *parts.columns, "score"
        )


def url_parts(url: Column) -> list[Column]:
    """Host (A-Z in lower case) and path of a url; both empty if it is null or has no ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    path = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)
    return [F.translate(host, upper, upper.lower()).alias("host"), path.alias("path")]


def _grams(text: Column, mark: str, sizes: tuple[int, ...]) -> Column:
    """Character n-grams of ``^text$``, each with a mark of where it is from."""
    framed = F.concat(F.lit("^"), text, F.lit("$"))

    def of(n: int) -> Column:
        last = F.length(framed) - n + 1
        at = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.concat(F.lit(mark), F.substring(framed, i, F.lit(n))))

    return F.concat(*[of(n) for n in sizes])


def with_grams(parts: DataFrame, sizes: tuple[int, ...] = GRAMS) -> DataFrame:
    grams = F.concat(_grams(F.col("host"), "h:", sizes), _grams(F.col("path"), "p:", sizes))
    return parts.withColumn("__grams", F.array_distinct(grams))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table: ``url``, ``label`` (1: block)."""
    rows = [(u, 1.0) for u in BLOCKED_URLS] + [(u, 0.0) for u in ALLOWED_URLS]
    pairs = [F.struct(F.lit(u).alias("url"), F.lit(y).alias("label")) for u, y in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*pairs)))


def fit(
    labelled: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    grams: tuple[int, ...] = GRAMS,
    buckets: int = BUCKETS,
) -> UrlFilter:
    """Train on ``labelled(url, label)``; ``rules`` is a short list (at most ``MAX_RULES``)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    tf = HashingTF(inputCol="__grams", outputCol="__features", numFeatures=buckets, binary=True)
    parts = labelled.select("label", *url_parts(F.col("url")))
    learner = LogisticRegression(
        featuresCol="__features",
        labelCol="label",
        predictionCol="__prediction",
        probabilityCol="__probability",
        rawPredictionCol="__raw",
        regParam=PENALTY,
        standardization=False,
        maxIter=200,
    )
    model = learner.fit(tf.transform(with_grams(parts, grams)).select("label", "__features"))
    return UrlFilter(tuple(rules), model, tf, tuple(grams))
