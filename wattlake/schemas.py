"""Silver and gold schemas plus the key catalogue."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L, B, DT, TS = (T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType(),
                         T.DateType(), T.TimestampNTZType())


def struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


def f(name, dtype, nullable=True):
    return (name, dtype, nullable)


# --- fixed values: table, column and key names of the warehouse (to the end of the file) ------
# --- silver -----------------------------------------------------------------
SENSOR = struct(f("date", DT), f("time", S), f("unit", S), f("value_acquired", D), f("variation", D))
PRODUCTION = struct(f("date", DT), f("time", S), f("inv_id", I), f("pac", D), f("daysum", D), f("status", S),
                    f("error", D), f("pdc1", D), f("pdc2", D), f("udc1", D), f("udc2", D), f("temp", D), f("uac", D))
WEATHER = struct(f("date", DT), f("time", S), f("value", D), f("prediction", D), f("site", S),
                 f("measurement", S), f("unit", S), f("issued", TS))
BOOKING = struct(*[f(c, DT if c == "date" else S) for c in [
    "date", "room_id", "start_time", "end_time", "reservation_id", "reservation_type", "reservation_code",
    "reserved_by", "alt_room_id", "activity_type", "instructor", "department", "class",
    "expense_category", "remarks", "comments"]])

# --- gold -------------------------------------------------------------------
GOLD = {
    "DimTime": struct(f("TimeID", S, False), f("Year", I), f("Month", I), f("Day", I), f("Hour", I),
                      f("Minute", I), f("Second", I)),
    "DimInverter": struct(f("InverterKey", S, False), f("InverterID", I)),
    "DimConsumption": struct(f("ConsumptionID", S, False), f("Value", D), f("Variation", D)),
    "DimHumidity": struct(f("HumidityID", S, False), f("Value", D), f("Variation", D)),
    "DimTemp": struct(f("TempID", S, False), f("Value", D), f("Variation", D)),
    "DimErrors": struct(f("ErrorID", S, False), f("Error_info", S)),
    "DimForecast": struct(f("ForecastID", S, False), f("Site", S), f("Measurement", S), f("Unit", S)),
    "DimRoom": struct(f("RoomID", S, False), f("Alt_RoomID", S), f("FullName", S), f("Alt_FullName", S)),
    "DimReservation": struct(f("ReservationID", S, False), f("Start_time", TS), f("End_time", TS),
                             f("List_Item", S), f("Activity", S), f("Class", S), f("Department", S),
                             f("Professor", S), f("ReservedBy", S)),
    "DimConsumptionPrediction": struct(f("Cons_PredictionID", S, False)),
    "DimProductionPredictionPac": struct(f("Prod_PredictionID", S, False), f("pred_date", DT), f("pred_hour", I),
                                         f("pred_sum_pac", D), f("sum_pac", D)),
    "DimProductionPredictionDaysum": struct(f("Prod_PredictionID", S, False), f("pred_date", DT),
                                            f("pred_hour", I), f("pred_daysum", D), f("daysum", D)),
    "Power_FactTable": struct(
        f("FactID", S, False), f("TimeID", S, False), f("ConsumptionID", S, False), f("InverterKey", S, False),
        f("ErrorID", S), f("Status", S), f("PAC", D), f("Daysum", D), f("PDC1", D), f("PDC2", D), f("UDC1", D),
        f("UDC2", D), f("Prod_vs_Consumption_Diff", D), f("Total_Production_End_of_Day", D),
        f("Total_Consumption_End_of_day", D), f("Pct_Inverters_Running", D), f("partition_date", DT, False)),
    "Weather_FactTable": struct(f("FactID", S, False), f("TimeID", S, False), f("ForecastID", S, False),
                                f("Most_Recent_Forecast", B), f("Humidity_Today", D), f("Temp_Today", D),
                                f("partition_date", DT, False)),
    "Rooms_FactTable": struct(f("FactID", S, False), f("TimeID", S, False), f("RoomID", S, False),
                              f("ReservationID", S), f("Pct_Rooms_Booked", D), f("Rooms_Free_Count", L),
                              f("partition_date", DT, False)),
    "Prediction_FactTable": struct(f("FactID", S, False), f("TimeID", S, False), f("Cons_PredictionID", S),
                                   f("Prod_PredictionIDPac", S), f("Prod_PredictionIDDaysum", S),
                                   f("Predicted_ProductionPac", D), f("Predicted_ProductionDaysum", D),
                                   f("Predicted_Consumption", D), f("partition_date", DT, False)),
}

PARTITION_COL = {name: ("partition_date" if name.endswith("FactTable") else None) for name in GOLD}

PRIMARY_KEYS = {name: schema.fields[0].name for name, schema in GOLD.items()}

# (fact, column, dimension, dimension key) as declared in the warehouse DDL
FOREIGN_KEYS = [
    ("Power_FactTable", "TimeID", "DimTime", "TimeID"),
    ("Power_FactTable", "ConsumptionID", "DimConsumption", "ConsumptionID"),
    ("Power_FactTable", "InverterKey", "DimInverter", "InverterKey"),
    ("Power_FactTable", "ErrorID", "DimErrors", "ErrorID"),
    ("Weather_FactTable", "TimeID", "DimTime", "TimeID"),
    ("Weather_FactTable", "ForecastID", "DimForecast", "ForecastID"),
    ("Rooms_FactTable", "TimeID", "DimTime", "TimeID"),
    ("Rooms_FactTable", "RoomID", "DimRoom", "RoomID"),
    ("Rooms_FactTable", "ReservationID", "DimReservation", "ReservationID"),
    ("Prediction_FactTable", "TimeID", "DimTime", "TimeID"),
]


def not_null_columns(name: str) -> list[str]:
    return [fl.name for fl in GOLD[name].fields if not fl.nullable]


def catalogue() -> dict:
    """``name -> (schema, partition column)`` for ``sinks.create_tables``."""
    return {n: (s, PARTITION_COL[n]) for n, s in GOLD.items()}
