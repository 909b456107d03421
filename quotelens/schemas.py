"""Row types and fixed values shared by every module."""

from pyspark.sql import types as T

# Label spellings, in the order the answer schema lists them.
LABELS = ("entailment", "contradiction", "not_mentioned")
NOT_MENTIONED = "not_mentioned"
RAW_NOT_MENTIONED = "notmentioned"

# The fields every answer must carry.
ANSWER_FIELDS = ("hypothesis_id", "label", "hypothesis", "source_clause")

# Length limits, loss mask, batch multiple, output ceiling, thresholds.
MAX_PROMPT_TOKENS = 9000
MAX_REQUEST_TOKENS = 5000
MAX_SEQUENCE = 11000
IGNORED_LABEL = -100
PAD_MULTIPLE = 8
MAX_OUTPUT_TOKENS = 3000
CLOSE_QUOTE = 0.75
ALARM_THRESHOLD = 0.7

# The questions asked of every document, by id (gaps are intended).
DEFAULT_LEGEND = (
    ("nda-1", "All Confidential Information shall be expressly identified by the Disclosing Party."),
    ("nda-2", "Confidential Information shall only include technical information."),
    ("nda-3", "Confidential Information may include verbally conveyed information."),
    ("nda-4", "Receiving Party shall not use any Confidential Information for any purpose other than the purposes stated in the Agreement."),
    ("nda-5", "Receiving Party may share some Confidential Information with some of Receiving Party's employees."),
    ("nda-7", "Receiving Party may share some Confidential Information with some third-parties (including consultants, agents and professional advisors)."),
    ("nda-8", "Receiving Party shall notify Disclosing Party in case Receiving Party is required by law, regulation or judicial process to disclose any Confidential Information."),
    ("nda-10", "Receiving Party shall not disclose the fact that Agreement was agreed or negotiated."),
    ("nda-11", "Receiving Party shall not reverse engineer any objects which embody Disclosing Party's Confidential Information."),
    ("nda-12", "Receiving Party may independently develop information similar to Confidential Information."),
    ("nda-13", "Receiving Party may acquire information similar to Confidential Information from a third party."),
    ("nda-15", "Agreement shall not grant Receiving Party any right to Confidential Information."),
    ("nda-16", "Receiving Party shall destroy or return some Confidential Information upon the termination of Agreement."),
    ("nda-17", "Receiving Party may create a copy of some Confidential Information in some circumstances."),
    ("nda-18", "Receiving Party shall not solicit some of Disclosing Party's representatives."),
    ("nda-19", "Some obligations of Agreement may survive termination of Agreement."),
    ("nda-20", "Receiving Party may retain some Confidential Information even after the return or destruction of Confidential Information."),
)

LEGEND = T.StructType(
    [
        T.StructField("hypothesis_id", T.StringType()),
        T.StructField("hypothesis", T.StringType()),
    ]
)

RAW_NLI = T.StructType(
    [
        T.StructField("document_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("hypothesis", T.StringType()),
        T.StructField("hypothesis_id", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("evidence_texts", T.ArrayType(T.StringType())),
    ]
)

ANSWER = T.StructType([T.StructField(name, T.StringType()) for name in ANSWER_FIELDS])

CURATED = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("document_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("inference", T.ArrayType(ANSWER)),
        T.StructField("model_repo", T.StringType()),
        T.StructField("model_repo_version", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("origin", T.StringType()),
    ]
)

LONG_FORM = T.StructType(
    [
        T.StructField("subset", T.StringType()),
        T.StructField("premise", T.StringType()),
        T.StructField(
            "hypothesises/labels",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("hypothesis", T.StringType()),
                        T.StructField("label", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

TRAINING_LOG = T.StructType(
    [
        T.StructField("step", T.LongType()),
        T.StructField("loss", T.DoubleType()),
        T.StructField("eval_loss", T.DoubleType()),
    ]
)

BENCH_SUMMARY = T.StructType(
    [
        T.StructField("tokenizer", T.StringType()),
        T.StructField("totalTimeMills", T.DoubleType()),
        T.StructField("totalRequests", T.LongType()),
        T.StructField("failedRequests", T.LongType()),
        T.StructField("errorRate", T.DoubleType()),
        T.StructField("concurrentClients", T.LongType()),
        T.StructField("tps", T.DoubleType()),
        T.StructField("tokenThroughput", T.DoubleType()),
        T.StructField("totalTokens", T.LongType()),
        T.StructField("tokenPerRequest", T.LongType()),
        T.StructField("averageLatency", T.DoubleType()),
        T.StructField("averageTokenLatency", T.DoubleType()),
        T.StructField("p50Latency", T.DoubleType()),
        T.StructField("p90Latency", T.DoubleType()),
        T.StructField("p99Latency", T.DoubleType()),
        T.StructField("timeToFirstByte", T.DoubleType()),
        T.StructField("p50TimeToFirstByte", T.DoubleType()),
        T.StructField("p90TimeToFirstByte", T.DoubleType()),
        T.StructField("p99TimeToFirstByte", T.DoubleType()),
    ]
)

PROMPT_PAYLOAD = T.StructType(
    [
        T.StructField("inputs", T.StringType()),
        T.StructField(
            "parameters",
            T.StructType(
                [
                    T.StructField("temperature", T.DoubleType()),
                    T.StructField("top_p", T.DoubleType()),
                    T.StructField("max_new_tokens", T.LongType()),
                    T.StructField("response_format", T.StringType()),
                ]
            ),
        ),
    ]
)
