"""Hand-made station exports."""

import os

from obslake.schema import LOCAL_HEADER, RAW_COLUMNS


def row(date, time, **cells):
    named = {"Date": date, "Time": time, **{k.replace("_", " "): v for k, v in cells.items()}}
    return "\t".join(str(named.get(c, "---")) for c in RAW_COLUMNS)


def write(folder, station, lines, name="Estación de prueba"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{station}.txt"), "w", encoding="utf-8") as f:
        f.write("\n".join([name, "\t".join(RAW_COLUMNS), "\t".join(LOCAL_HEADER), *lines]) + "\n")


def days(n, start="2023-01-01", per_day=48, **fixed):
    """``per_day`` half-hourly rows for each of ``n`` days."""
    import datetime as dt
    first = dt.datetime.fromisoformat(start)
    out = []
    for d in range(n):
        for i in range(per_day):
            at = first + dt.timedelta(days=d, minutes=30 * i)
            cells = {"Temp_Out": 20 + d % 10 + i / 10, "Out_Hum": 60, "Wind_Speed": 5.0, "Hi_Speed": 9.0, "Wind_Dir": "SSW",
                     "Bar": 1010.0, "Rain": 0.1, "Solar_Rad.": 300, "UV_Index": 3.3, "ET": 0.1, "Heat_Index": 25.0, "THSW_Index": 27.0,
                     "Arc._Int.": 30}
            cells.update({k: (v(d, i) if callable(v) else v) for k, v in fixed.items()})
            out.append(row(at.strftime("%d/%m/%y"), at.strftime("%H:%M"), **cells))
    return out
