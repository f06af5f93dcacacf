"""Fixed-width record layouts of the solar-wind archive."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sunloom.functions.times import day_of_year_timestamp


@dataclass(frozen=True)
class Field:
    name: str
    start: int  # zero-based
    width: int
    decimals: int | None  # None for an integer field
    fill: float | None


@dataclass(frozen=True)
class RecordLayout:
    table: str
    fields: tuple[Field, ...]
    timestamp: Callable[[], Column]

    @property
    def length(self) -> int:
        return self.fields[-1].start + self.fields[-1].width


def nines(width: int, decimals: int | None) -> float:
    """Fill value of a field: all nines, leaving the leading blank of the field."""
    if not decimals:
        return float("9" * (width - (1 if decimals is None else 2)))
    return float("9" * (width - decimals - 2) + "." + "9" * decimals)


def expand_format(fmt: str) -> list[tuple[int, int | None]]:
    """(width, decimals) per field of a Fortran record format."""
    out: list[tuple[int, int | None]] = []
    for item in fmt.strip("() ").split(","):
        repeat, kind, width, decimals = re.fullmatch(r"\s*(\d*)([IFA])(\d+)(?:\.(\d+))?\s*", item).groups()
        shape = (int(width), int(decimals or 0) if kind == "F" else None)
        out += [shape] * int(repeat or 1)
    return out


def make_layout(
    table: str, fmt: str, names: list[str], unfilled: set[str], timestamp: Callable[[], Column]
) -> RecordLayout:
    shapes = expand_format(fmt)
    if len(shapes) != len(names):
        raise ValueError(f"{table}: {len(shapes)} fields for {len(names)} names")
    fields, start = [], 0
    for name, (width, decimals) in zip(names, shapes):
        fill = None if name in unfilled else nines(width, decimals)
        fields.append(Field(name, start, width, decimals, fill))
        start += width
    return RecordLayout(table, tuple(fields), timestamp)


# Record formats and field names of the three archive files.
HOURLY_FORMAT = (
    "(2I4,I3,I5,2I3,2I4,14F6.1,F9.0,F6.1,F6.0,2F6.1,F6.3,F6.2,F9.0,F6.1,F6.0,2F6.1,F6.3,"
    "2F7.2,F6.1,I3,I4,I6,I5,F10.2,5F9.2,I3,I4,F6.1,F6.1,2I6,F5.1)"
)
MINUTE_FORMAT = (
    "(2I4,4I3,3I4,2I7,F6.2,I7,8F8.2,4F8.1,F7.2,F9.0,F6.2,2F7.2,F6.1,6F8.2,7I6,F7.2,F5.1)"
)
FIVE_MINUTE_FORMAT = MINUTE_FORMAT[:-1] + ",3F9.2)"

HOURLY_NAMES = """
Year Decimal_Day Hour Bartels_Rotation_Number
IMF_SC_ID SW_Plasma_SC_ID IMF_Avg_Points Plasma_Avg_Points
B_Field_Magnitude_Avg_nT B_Magnitude_of_Avg_Field_Vector_nT
B_Lat_Angle_Avg_Field_Vector_deg B_Long_Angle_Avg_Field_Vector_deg
Bx_GSE_GSM_nT By_GSE_nT Bz_GSE_nT By_GSM_nT Bz_GSM_nT
Sigma_B_Magnitude_nT Sigma_B_Vector_nT Sigma_Bx_nT Sigma_By_nT Sigma_Bz_nT
Proton_Temperature_K Proton_Density_n_cm3 Plasma_Flow_Speed_km_s
Plasma_Flow_Long_Angle_deg Plasma_Flow_Lat_Angle_deg
Na_Np_Ratio Flow_Pressure_nPa
Sigma_Temperature_K Sigma_Density_n_cm3 Sigma_Flow_Speed_km_s
Sigma_Phi_V_deg Sigma_Theta_V_deg Sigma_Na_Np
Electric_Field_mV_m Plasma_Beta Alfven_Mach_Number
Kp_Index Sunspot_Number_R DST_Index_nT AE_Index_nT
Proton_Flux_gt1MeV Proton_Flux_gt2MeV Proton_Flux_gt4MeV
Proton_Flux_gt10MeV Proton_Flux_gt30MeV Proton_Flux_gt60MeV
Flag ap_Index_nT f10_7_Index_sfu PC_N_Index
AL_Index_nT AU_Index_nT Magnetosonic_Mach_Number
""".split()

MINUTE_NAMES = """
Year Day Hour Minute
IMF_SC_ID SW_Plasma_SC_ID IMF_Avg_Points Plasma_Avg_Points Percent_Interp
Timeshift_sec RMS_Timeshift RMS_Phase_Front_Normal Time_Between_Obs_sec
B_Magnitude_nT Bx_GSE_nT By_GSE_nT Bz_GSE_nT By_GSM_nT Bz_GSM_nT
RMS_SD_B_Scalar_nT RMS_SD_B_Vector_nT
Flow_Speed_km_s Vx_GSE_km_s Vy_GSE_km_s Vz_GSE_km_s
Proton_Density_n_cc Temperature_K Flow_Pressure_nPa Electric_Field_mV_m
Plasma_Beta Alfven_Mach_Number
SC_X_GSE_Re SC_Y_GSE_Re SC_Z_GSE_Re
BSN_X_GSE_Re BSN_Y_GSE_Re BSN_Z_GSE_Re
AE_Index_nT AL_Index_nT AU_Index_nT
SYM_D_nT SYM_H_nT ASY_D_nT ASY_H_nT
PC_N_Index Magnetosonic_Mach_Number
""".split()

FIVE_MINUTE_NAMES = [*MINUTE_NAMES, "Proton_Flux_gt10MeV", "Proton_Flux_gt30MeV", "Proton_Flux_gt60MeV"]


def _hourly_time() -> Column:
    return day_of_year_timestamp(F.col("Year"), F.col("Decimal_Day"), F.col("Hour"))


def _minute_time() -> Column:
    return day_of_year_timestamp(F.col("Year"), F.col("Day"), F.col("Hour"), F.col("Minute"))


HOURLY = make_layout(
    "omni_low_resolution", HOURLY_FORMAT, HOURLY_NAMES, {"Year", "Decimal_Day", "Hour", "Flag"}, _hourly_time
)
MINUTE = make_layout(
    "omni_high_resolution", MINUTE_FORMAT, MINUTE_NAMES, {"Year", "Day", "Hour", "Minute"}, _minute_time
)
FIVE_MINUTE = make_layout(
    "omni_high_resolution_5min",
    FIVE_MINUTE_FORMAT,
    FIVE_MINUTE_NAMES,
    {"Year", "Day", "Hour", "Minute"},
    _minute_time,
)
LAYOUTS = {layout.table: layout for layout in (HOURLY, MINUTE, FIVE_MINUTE)}
