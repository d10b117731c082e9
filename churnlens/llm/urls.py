"""URL verdicts: host rules first, then a logistic regression on hashed
character n-grams of host and path.  All of it runs in the JVM."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Host names labelled by hand for the default training table.
BLOCK_HOSTS = """
casino-royal.example.com bestcasino.example.org live-casino.example.net casinobonus.example.com
win-big.example.org lucky-win.example.com slots-win.example.net jackpot-slots.example.org
sports-bets.example.com bets24.example.org free-spins.example.com online-betting.example.net
free-money.example.org cheap-meds.example.com pills-shop.example.org buy-pills.example.net
diet-pills.example.com cheap-viagra.example.org replica-watch.example.com cheap-loans.example.net
adult-video.example.com xxx-adult.example.org adult-cams.example.net hot-xxx.example.com
spam-mail.example.org spam-links.example.com link-farm.example.net seo-farm.example.org
ads-server.example.com popup-ads.example.org ad-track.example.net click-track.example.com
tracker-ads.example.org download-crack.example.com warez-farm.example.net torrent-x.example.org
""".split()
ALLOW_HOSTS = """
news.example.com weather.example.org library.example.net museum.example.com university.example.org
science.example.net history.example.com garden.example.org kitchen.example.net travel.example.com
thewriter.example.org theatre.example.com thinking.example.net theory.example.org motion.example.com
nation.example.net station.example.org education.example.com translation.example.net the-times.example.org
health.example.com northern.example.net weatherman.example.org theearth.example.com thesis.example.net
other.example.org brother.example.com gather.example.net tionary.example.org trination.example.com
docs.example.org wiki.example.net archive.example.com journal.example.org software.example.net
physics.example.com
""".split()


#: Whole URLs labelled by hand: other kinds of hosts, domains and paths.
BLOCK_URLS = """
https://www.royalpoker.eu/promo/welcome-bonus http://pokerroom.bet/signup?ref=77 https://spin-palace.casino/slots
https://megajackpot.io/play/free-spins https://betkings.co.uk/football/odds http://www.bet-now.de/sportwetten/
https://onlinekasino.de/bonus https://paris-sportifs-bonus.fr/inscription http://apuestas24.es/casino
https://roulette-live.net/tables/3 https://bingo4cash.com/join http://blackjack-tips.biz/win https://lotto-winner.xyz/claim
https://sexcams.tv/live http://freeporn.xxx/videos/113 https://hotgirls-chat.com/rooms https://adultfriend.club/profiles
http://escort-berlin.de/models https://nudes.cam/top http://www.xxxtube.ru/watch?v=9 https://milfdating.online/meet
https://cheap-rx-pharmacy.ru/viagra-100mg http://buycialis.top/order https://onlinepharma24.com/no-prescription
https://weightloss-pills.shop/keto-gummies https://steroids4u.eu/catalog http://tramadol-express.biz/buy
https://rolex-replicas.cn/submariner http://fakebags.store/louis-vuitton https://replica-shoes.ru/nike
https://getrichfast.info/bitcoin-doubler https://crypto-doubler.io/deposit http://forex-signals.biz/vip
https://payday-loan-now.com/apply http://quickcash-loans.us/no-credit-check https://free-iphone-prize.win/claim-now
http://you-won.click/gift-card https://survey-rewards.xyz/amazon-voucher http://secure-login-paypa1.com/verify
https://appleid-unlock.support/login http://bank-account-verify.info/update https://wallet-recover.org/seed-phrase
https://crackedsoft.net/photoshop-keygen http://serials-keys.ws/windows-activator https://warezbb.to/download/iso
https://thepiratemirror.se/torrent/882 http://freemovies-hd.cc/stream https://nulled-scripts.io/themes
https://adclick-tracker.com/c?id=3 http://popads.biz/pop.js https://doubleads.net/banner/300x250 https://clickbank-ads.co/redirect
http://backlinks-cheap.com/buy-seo-links https://linkfarm.biz/directory http://article-spinner.top/seo-spam
https://bulkmailer.ru/spam-tools http://email-lists.biz/buy-leads https://followers4instagram.shop/likes
""".split()
ALLOW_URLS = """
https://www.bbc.com/news/science-environment https://www.nytimes.com/2021/05/04/health/vaccines.html
https://www.theguardian.com/world/2020/jan/31/brexit https://www.lefigaro.fr/culture/musique https://www.zeit.de/wissen
https://www.faz.net/aktuell/politik/ https://elpais.com/internacional/2022-03-01 https://www.corriere.it/cronache/
https://www.lesechos.fr/industrie http://www.asahi.com/articles https://www.reuters.com/markets/europe
https://en.wikipedia.org/wiki/Best-fit_algorithm https://de.wikipedia.org/wiki/Berlin https://fr.wiktionary.org/wiki/mot
https://arxiv.org/abs/1706.03762 https://www.nature.com/articles/s41586-020 https://www.science.org/doi/10.1126
https://pubmed.ncbi.nlm.nih.gov/31452104/ https://www.cambridge.org/core/journals https://www.mit.edu/research/
https://www.ox.ac.uk/admissions https://www.uni-heidelberg.de/de/studium https://www.sorbonne-universite.fr/formations
https://www.nasa.gov/missions/artemis https://www.who.int/health-topics/nutrition https://europa.eu/youth/volunteering
https://www.gov.uk/browse/driving https://www.service-public.fr/particuliers https://www.usa.gov/benefits
https://gitlab.com/explore/projects https://pypi.org/project/numpy/ https://docs.python.org/3/library/re.html
https://developer.mozilla.org/en-US/docs/Web/CSS https://stackoverflow.com/questions/11227809 https://www.kernel.org/doc/html/
https://www.postgresql.org/docs/current/ https://www.rust-lang.org/learn https://spark.apache.org/docs/latest/
https://www.debian.org/releases/ https://www.w3.org/TR/html52/ https://www.rfc-editor.org/rfc/rfc7231
https://www.goodreads.com/book/show/5107 https://www.gutenberg.org/ebooks/1342 https://www.imdb.com/title/tt0111161/
https://www.chefkoch.de/rezepte/apfelkuchen https://www.marmiton.org/recettes/ratatouille https://www.seriouseats.com/pizza-dough
https://www.metoffice.gov.uk/weather/forecast https://www.bahn.de/fahrplan https://www.sncf-connect.com/horaires
https://www.lonelyplanet.com/italy/rome https://www.nationalgeographic.com/animals https://www.rei.com/learn/hiking
https://www.khanacademy.org/math/algebra https://www.coursera.org/learn/machine-learning https://www.duolingo.com/course
https://blog.cloudflare.com/http3 https://martinfowler.com/articles/microservices.html https://www.joelonsoftware.com/2000/04/06
https://www.allrecipes.com/recipe/20144 https://www.mayoclinic.org/diseases-conditions/asthma https://www.apotheken-umschau.de/
https://www.fifa.com/tournaments https://www.olympics.com/en/athletes https://www.kicker.de/bundesliga/tabelle
https://www.sparkasse.de/girokonto https://www.ecb.europa.eu/stats https://www.bundesbank.de/de/aufgaben
""".split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label): the hand-labelled hosts, each with the usual prefixes and
    kinds of paths, and the hand-labelled URLs, each whole and by its host; 1 is block."""
    rows = []
    for label, hosts in ((1.0, BLOCK_HOSTS), (0.0, ALLOW_HOSTS)):
        for i, host in enumerate(hosts):
            for j, prefix in enumerate(("", "www.", "blog.", "m.")):
                lang = ("en", "de", "fr", "es")[(i + j) % 4]
                tail = ("", ".html", "/", "")[(i + 2 * j) % 4]
                rows.append((f"https://{prefix}{host}/{lang}/{(37 * i + 11 * j) % 1000}{tail}", label))
    for label, urls in ((1.0, BLOCK_URLS), (0.0, ALLOW_URLS)):
        for url in urls:
            scheme, _, rest = url.partition("://")
            rows += [(url, label), (f"{scheme}://{rest.partition('/')[0]}/", label)]
    return spark.createDataFrame(rows, "url string, label double").coalesce(1)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without `://`."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return host, path


def rule_for(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (like `net/` or `example.com/de/`) that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        own, slash, start = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def fit_urls(labelled: DataFrame, orders: tuple[int, ...] = (3, 4), features: int = 1 << 12,
             reg: float = 0.01) -> PipelineModel:
    """Logistic regression on character n-grams of host and path of (url, label)
    rows.  The table is hand-labelled: it is small whatever the corpus."""
    stages = [RegexTokenizer(inputCol="_spot", outputCol="_chars", pattern=r"(?s).", gaps=False)]
    for n in orders:
        stages += [NGram(n=n, inputCol="_chars", outputCol=f"_grams{n}"),
                   HashingTF(numFeatures=features, binary=True, inputCol=f"_grams{n}", outputCol=f"_tf{n}")]
    stages += [VectorAssembler(inputCols=[f"_tf{n}" for n in orders], outputCol="_features"),
               LogisticRegression(featuresCol="_features", labelCol="label", regParam=reg, maxIter=30,
                                  rawPredictionCol="_raw", probabilityCol="_probability",
                                  predictionCol="_prediction")]
    host, path = host_and_path(F.col("url"))
    return Pipeline(stages=stages).fit(
        labelled.filter("label is not null").select("label", F.concat(F.lit("^"), host, path).alias("_spot")))


def judge_urls(pages: DataFrame, model: PipelineModel, rules: dict[str, str], id_col: str = "page_id",
               url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """(id_col, host, path, rule, verdict, score) of every row.

    A rule's verdict holds, else the model's: block from ``threshold`` on.  A
    null url, or one without `://`, has an empty host and path, fits no rule and
    is scored as such.  Ids may be null or repeat; other columns are ignored.
    """
    host, path = host_and_path(F.col(url_col))
    spots = pages.select(F.col(id_col).alias("_id"), host.alias("_host"), path.alias("_path"))
    scored = model.transform(spots.withColumn("_spot", F.concat(F.lit("^"), "_host", "_path")))
    verdict = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    by_rule = F.lit(None).cast("string")
    for rule, own in rules.items():
        by_rule = F.when(F.col("rule") == rule, F.lit(own)).otherwise(by_rule)
    return (scored.select(F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"),
                          rule_for(F.col("_host"), F.col("_path"), rules).alias("rule"),
                          vector_to_array("_probability")[1].alias("score"))
            .withColumn("verdict", F.coalesce(by_rule, verdict))
            .select(id_col, "host", "path", "rule", "verdict", "score"))
