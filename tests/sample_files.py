"""Small yearly files in the real layout, values chosen by hand rules."""

import csv
import os

from stratalake.schemas import INSTITUTION_COLUMNS, PROGRAM_COLUMNS

YEARS = (2000, 2009, 2010, 2012, 2020, 2025)
UNITS = 24


def institution_row(year: int, unit: int) -> dict[str, str]:
    sector = unit % 3 + 1
    if unit == 5 and year >= 2012:
        sector = 2 if sector != 2 else 1
    empty_year = year in (2000, 2025)
    row = {name: "NULL" for name in INSTITUTION_COLUMNS}
    row.update(
        UNITID=str(100 + unit),
        OPEID6=f"{unit:06d}",
        INSTNM=f"School {unit}" if year < 2020 else f"School {unit}, New",
        CITY="Town",
        STABBR="NY" if unit % 2 else "CA",
        CONTROL="NULL" if (year, unit) == (2009, 7) else str(sector),
        PREDDEG="3" if unit % 4 else "1",
        REGION=str(unit % 5),
        UGDS="NULL" if empty_year else str(1000 * unit + year % 100),
        TUITIONFEE_IN="NULL" if year == 2025 else str(3000 + 100 * unit),
        NPT4_PUB=str(9000 + unit) if sector == 1 else "NULL",
        NPT4_PRIV=str(19000 + unit) if sector != 1 else "PS",
        C150_4="0.5" if unit % 2 else "NA",
        C150_L4="0.25",
        GRAD_DEBT_MDN="PrivacySuppressed" if unit % 6 == 0 else f"{20000 + 37 * unit}.5",
        MD_EARN_WNE_P10=str(40000 + 111 * unit) if year == 2020 else "NULL",
        LOCALE="12.0",
    )
    return row


def present(year: int, unit: int) -> bool:
    return not (year == 2025 and unit % 3 == 2) and not (unit == 23 and year > 2010)


def program_rows(cohort: str):
    for unit in range(UNITS):
        for field in range(30):
            code = f"{(14, 52)[field % 2]}{field:02d}"
            yield {
                "UNITID": str(100 + unit),
                "CIPCODE": code,
                "CIPDESC": f"Field {code}",
                "CREDLEV": str(field % 3 + 2),
                "CREDDESC": f"Level {field % 3 + 2}",
                "IPEDSCOUNT1": str(field),
                "IPEDSCOUNT2": "PS",
                "DEBT_ALL_STGP_EVAL_MDN": "PS" if field == 9 else f"{15000 + 13 * unit + 7 * field}.0",
                "EARN_MDN_1YR": str(30000 + 5 * field),
                "EARN_MDN_4YR": str(50000 + 17 * unit + 101 * field + (20000 if code < "20" else 0)),
            }


def _write(path: str, columns: list[str], rows) -> None:
    with open(path, "w", encoding="utf-8", newline="") as handle:
        writer = csv.DictWriter(handle, columns)
        writer.writeheader()
        writer.writerows(rows)


def write_files(folder: str, years=YEARS, cohorts=("1718_1819", "1819_1920")) -> None:
    os.makedirs(folder, exist_ok=True)
    for year in years:
        # The later layout carries a column more and another order.
        columns = list(INSTITUTION_COLUMNS) if year < 2012 else ["UNUSED", *reversed(INSTITUTION_COLUMNS)]
        rows = [institution_row(year, unit) for unit in range(UNITS) if present(year, unit)]
        if year >= 2012:
            rows = [{"UNUSED": "x", **row} for row in rows]
        _write(f"{folder}/MERGED{year}_{(year + 1) % 100:02d}_PP.csv", columns, rows)
    for cohort in cohorts:
        _write(f"{folder}/FieldOfStudyData{cohort}_PP.csv", list(PROGRAM_COLUMNS), program_rows(cohort))
    _write(
        f"{folder}/CIPCode2020.csv",
        ["CIPCode", "CIPTitle"],
        [
            {"CIPCode": '="14"', "CIPTitle": "ENGINEERING."},
            {"CIPCode": '="14.01"', "CIPTitle": "Engineering, General."},
            {"CIPCode": '="52"', "CIPTitle": "BUSINESS AND RELATED SERVICES."},
        ],
    )
