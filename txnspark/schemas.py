"""Schemas of the messages and warehouse tables, and the fixed value lists of the contracts."""

from __future__ import annotations

from pyspark.sql import types as T

TRANSACTION_MESSAGE = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("card_type", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("location_country", T.StringType()),
        T.StructField("location_city", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

INDICATOR_MESSAGE = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("indicator_id", T.StringType()),
        T.StructField("indicator_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("date", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("frequency", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

EXCHANGE_RATE_MESSAGE = T.StructType(
    [
        T.StructField("base_currency", T.StringType()),
        T.StructField("target_currency", T.StringType()),
        T.StructField("rate", T.DoubleType()),
        T.StructField("api_timestamp_unix", T.LongType()),
        T.StructField("api_timestamp_iso_utc", T.StringType()),
        T.StructField("fetch_timestamp_iso_utc", T.StringType()),
    ]
)

RATE_SNAPSHOT = T.StructType(
    [
        T.StructField("base", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("rates", T.MapType(T.StringType(), T.DoubleType())),
    ]
)

INDICATOR_OBSERVATION = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

RAW_ENVELOPE = T.StructType(
    [
        T.StructField("record_content", T.StringType()),
        T.StructField("record_metadata", T.StringType()),
    ]
)

RAW_TRANSACTIONS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("client_id", T.LongType()),
        T.StructField("card_id", T.LongType()),
        T.StructField("merchant_id", T.LongType()),
        T.StructField("merchant_city", T.StringType()),
        T.StructField("merchant_state", T.StringType()),
        T.StructField("zip", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("use_chip", T.BooleanType()),
        T.StructField("date", T.TimestampNTZType()),
    ]
)

RAW_CARDS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("client_id", T.LongType()),
        T.StructField("card_brand", T.StringType()),
        T.StructField("card_type", T.StringType()),
        T.StructField("card_number", T.StringType()),
        T.StructField("expires", T.StringType()),
        T.StructField("cvv", T.StringType()),
        T.StructField("has_chip", T.BooleanType()),
        T.StructField("num_cards_issued", T.IntegerType()),
        T.StructField("credit_limit", T.DoubleType()),
    ]
)

RAW_USERS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("current_age", T.IntegerType()),
        T.StructField("birth_year", T.IntegerType()),
        T.StructField("birth_month", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

RAW_INDICATORS = T.StructType(
    [
        T.StructField("indicator", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("frequency", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)

RAW_FRAUD_LABELS = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("is_fraud", T.BooleanType()),
    ]
)

# Nested documents a producer may send along with transactions.
_LOCATION = T.StructType(
    [
        T.StructField("country", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("postal_code", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

USER_DOCUMENT = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("occupation", T.StringType()),
        T.StructField("account_created", T.StringType()),
        T.StructField("location", _LOCATION),
        T.StructField(
            "financial",
            T.StructType(
                [
                    T.StructField("credit_score", T.IntegerType()),
                    T.StructField("risk_score", T.DoubleType()),
                    T.StructField("income_bracket", T.StringType()),
                    T.StructField("preferred_payment_methods", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        T.StructField(
            "preferences",
            T.StructType(
                [
                    T.StructField("spending_categories", T.ArrayType(T.StringType())),
                    T.StructField("communication_channel", T.StringType()),
                ]
            ),
        ),
    ]
)

MERCHANT_DOCUMENT = T.StructType(
    [
        T.StructField("merchant_id", T.StringType()),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("location", _LOCATION),
        T.StructField(
            "business",
            T.StructType(
                [
                    T.StructField("founding_date", T.StringType()),
                    T.StructField("size", T.StringType()),
                    T.StructField("website", T.StringType()),
                    T.StructField("employees", T.IntegerType()),
                ]
            ),
        ),
        T.StructField(
            "payment",
            T.StructType(
                [
                    T.StructField("methods", T.ArrayType(T.StringType())),
                    T.StructField("currency", T.StringType()),
                    T.StructField("online_payments", T.BooleanType()),
                ]
            ),
        ),
        T.StructField(
            "risk",
            T.StructType(
                [
                    T.StructField("fraud_history", T.BooleanType()),
                    T.StructField("risk_score", T.DoubleType()),
                    T.StructField("last_audit", T.StringType()),
                ]
            ),
        ),
    ]
)

# Contract enumerations, patterns and limits.
CARD_TYPES = ["Visa", "MasterCard", "Amex", "Discover", "Other"]
MERCHANT_CATEGORIES = [
    "Retail",
    "Electronics",
    "Travel",
    "Dining",
    "Services",
    "Health",
    "Entertainment",
    "Education",
    "Finance",
    "Real Estate",
    "Automotive",
]
FREQUENCIES = ["daily", "monthly", "quarterly", "annually"]
CURRENCY_PATTERN = "^[A-Z]{3}$"
COUNTRY_PATTERN = "^[A-Z]{2}$"
MIN_AMOUNT = "0.01"
MAX_STAGED_AMOUNT = "10000"
MAX_STAGED_USER = 10000

# The tracked economic series (code, name, frequency, country).
INDICATOR_SERIES = [
    ("UNRATE", "Unemployment Rate", "monthly", "US"),
    ("CPIAUCSL", "Consumer Price Index", "monthly", "US"),
    ("GDP", "Gross Domestic Product", "quarterly", "US"),
    ("FEDFUNDS", "Federal Funds Rate", "monthly", "US"),
    ("UMCSENT", "Consumer Sentiment", "monthly", "US"),
    ("RSAFS", "Retail Sales", "monthly", "US"),
    ("HOUST", "Housing Starts", "monthly", "US"),
    ("INDPRO", "Industrial Production Index", "monthly", "US"),
]
