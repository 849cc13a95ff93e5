"""The fifteen corpora. Names, files, columns and rules are fixed values: they are the layout users know."""

from foldloom.functions.labels import STAR_POLARITY
from foldloom.plans import vocabularies as v
from foldloom.plans.spec import Converted, CorpusSpec, Delimited, JsonLines

EITHER_ENCODING = Delimited(fallback_encoding="ISO-8859-1")

# A review with a title: title and body become the text, stars become the polarity.
STAR_REVIEW = dict(
    title_column="review_title",
    null_text="",
    strip_text=True,
    drop_blank_text=True,
    label_rule="lenient_integer",
    labels=STAR_POLARITY,
)

# A review that already has a 0/1 polarity.
POLAR_REVIEW = dict(
    source=EITHER_ENCODING,
    null_text="",
    strip_text=True,
    drop_blank_text=True,
    label_rule="lenient_integer",
    labels=v.POLARITY,
)

SPECS = (
    CorpusSpec(
        "category", "RulingBRCorpus", ["rulingbr-v1.2.jsonl"], "ementa", "area",
        source=JsonLines(truthy=True), admitted=v.LAW_AREAS, fold_rule="stratified",
    ),
    CorpusSpec(
        "category", "EniacCorpus", ["dataset-eniac-2023.csv"], "sentenca", "categoria",
        drop_blank_text=True, label_rule="first_item",
    ),
    CorpusSpec(
        "category", "MMLU_PTBR_Corpus", ["mmlu_PT-BR.csv"], "Question", "Subject",
        source=Delimited(fallback_sep="\t"), labels=v.EXAM_SUBJECTS,
    ),
    CorpusSpec(
        "category", "RecognasummCorpus", ["train.jsonl", "validation.jsonl", "test.jsonl"], "Noticia", "Categoria",
        source=JsonLines(truthy=True), labels=v.NEWS_SECTIONS, keep_unmapped=False,
    ),
    CorpusSpec(
        "hate", "HateBRCorpus", ["HateBR.csv"], "comentario", "label_final",
        label_rule="strict_integer", labels=v.OFFENSE,
    ),
    CorpusSpec(
        "hate", "TuPyCorpus", ["binary_train.csv", "binary_test.csv"], "text", "hate",
        label_rule="strict_integer", labels=v.OFFENSE,
    ),
    CorpusSpec(
        "intent", "CourtDecisionCorpus", ["courtdecision_intent.csv"], "ementa_text", "decision_label",
        source=Delimited(sep="<=>", quoted=False, multiline=False),
        admitted=tuple(v.COURT_DECISIONS), labels=v.COURT_DECISIONS,
    ),
    CorpusSpec(
        "intent", "IntentPTCorpus", ["pt-PT.jsonl"], "utt", "intent",
        source=JsonLines(), labels=v.INTENTS, fold_rule="stratified",
    ),
    CorpusSpec(
        "reviews", "B2WReviewsCorpus", ["B2W-reviews.csv"], "review_text", "overall_rating", **STAR_REVIEW,
    ),
    CorpusSpec(
        "reviews", "BrandsCorpus", ["brandsBr.parquet"], "review_text", "overall_rating",
        source=Converted(), **STAR_REVIEW,
    ),
    CorpusSpec(
        "reviews", "BuscapeCorpus", ["buscape.csv"], "review_text", "polarity", **POLAR_REVIEW,
    ),
    CorpusSpec(
        "reviews", "OlistCorpus", ["olist.csv"], "review_text", "polarity", **POLAR_REVIEW,
    ),
    CorpusSpec(
        "reviews", "KaggleTweetsCorpus", ["NoThemeTweets.csv"], "tweet_text", "sentiment",
        source=EITHER_ENCODING, admitted=v.TWEET_SENTIMENTS,
    ),
    CorpusSpec(
        "reviews", "ReProCorpus", ["RePro.csv"], "review_text", "overall_rating", **STAR_REVIEW,
    ),
    CorpusSpec(
        "reviews", "UTLCorpus",
        [
            "train_apps.parquet", "train_filmes.parquet", "dev_apps.parquet", "dev_filmes.parquet",
            "test_apps.parquet", "test_filmes.parquet",
        ],
        "text", "stars",
        source=Converted(), strip_text=True, drop_blank_text=True,
        label_rule="lenient_integer", labels=STAR_POLARITY,
    ),
)

BY_NAME = {spec.corpus: spec for spec in SPECS}
