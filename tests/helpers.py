import datetime as dt

DAY = dt.date(2024, 1, 1)
SEGMENT = ("EMEA", "Mobile", "Safari", "Email", "SMB")
PANEL = (
    "date date, kpi_name string, region string, device_type string, browser string, channel string, "
    "business_segment string, kpi_value double"
)


def series(values, kpi="conversion_rate", segment=SEGMENT, start=DAY):
    return [(start + dt.timedelta(days=i), kpi, *segment, float(v)) for i, v in enumerate(values)]


def panel(spark, *parts):
    return spark.createDataFrame([row for part in parts for row in part], PANEL)


def by_date(df, *columns):
    return [tuple(row) for row in df.orderBy("date").select(*columns).collect()]


ANOMALY = (
    "date date, kpi_name string, region string, device_type string, browser string, channel string, "
    "business_segment string, actual_value double, expected_value double, moving_baseline double, "
    "percent_variance double, monitoring_status string, threshold_breached boolean, residual_anomaly boolean, "
    "residual_severity string"
)


def anomaly_row(actual, expected, kpi="conversion_rate", region="EMEA", severity="WARNING", flagged=True, date=DAY,
                device="Mobile", browser="Safari", channel="Email", segment="SMB"):
    variance = None if expected is None else (actual - expected) / expected
    return (date, kpi, region, device, browser, channel, segment, actual, expected, expected, variance, severity,
            flagged, flagged, severity)


def anomalies(spark, *rows):
    return spark.createDataFrame(list(rows), ANOMALY)
