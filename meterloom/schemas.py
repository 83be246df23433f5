"""Fixed schemas of the input files and the column names used throughout the package."""

from pyspark.sql import types as T

READINGS = T.StructType(
    [
        T.StructField("meter_id", T.LongType(), False),
        T.StructField("read_date", T.DateType(), False),
        T.StructField("reg_offpeak", T.DoubleType(), True),
        T.StructField("reg_peak", T.DoubleType(), True),
        T.StructField("reg_shoulder", T.DoubleType(), True),
        T.StructField("state", T.StringType(), True),
    ]
)

WEATHER = T.StructType(
    [
        T.StructField("station_id", T.LongType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("tmax", T.DoubleType(), True),
        T.StructField("tmin", T.DoubleType(), True),
        T.StructField("humidity", T.DoubleType(), True),
        T.StructField("rain", T.DoubleType(), True),
        T.StructField("uv", T.DoubleType(), True),
    ]
)

MONTHLY_TEXT = T.StructType(
    [
        T.StructField("meter_id", T.LongType(), False),
        T.StructField("month_text", T.StringType(), False),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("month", T.IntegerType(), True),
        T.StructField("season", T.StringType(), True),
        T.StructField("days_in_month", T.IntegerType(), True),
        T.StructField("offpeak_kwh", T.DoubleType(), True),
        T.StructField("onpeak_kwh", T.DoubleType(), True),
        T.StructField("total_kwh", T.DoubleType(), True),
        T.StructField("kwh_per_day", T.DoubleType(), True),
        T.StructField("offpeak_ratio", T.DoubleType(), True),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("model", T.StringType(), False),
        T.StructField("split", T.StringType(), False),
        T.StructField("sample_id", T.LongType(), False),
        T.StructField("y", T.DoubleType(), True),
        T.StructField("yhat", T.DoubleType(), True),
    ]
)

# Column headers of the household's own files -> our names (fixed values).
READINGS_HEADER = {
    "Data da Leitura": "read_date",
    "Vazio": "reg_offpeak",
    "Ponta": "reg_peak",
    "Cheias": "reg_shoulder",
}
WEATHER_HEADER = {
    "Date": "date",
    "Temperature_Max_C": "tmax",
    "Temperature_Min_C": "tmin",
    "Humidity_Mean_%": "humidity",
    "Precipitation_mm": "rain",
    "UV_Index_Max": "uv",
}

CUTOFF_DAYS = (10, 15, 20, 25)
TRAILING_ROWS = 7

NUMERIC_FEATURES = (
    "cum_offpeak_kwh",
    "cum_onpeak_kwh",
    "cum_total_kwh",
    "days_elapsed",
    "days_remaining",
    "avg7_offpeak",
    "avg7_onpeak",
    "avg7_total",
    "temperature",
    "humidity",
    "projected_bill",
)
CATEGORICAL_FEATURES = ("month", "season", "occupancy")
TARGET = "bill"
