"""

builtin: a Spark primitive as it is; composed: a composition of columns or DataFrames; udf: Arrow batches of Python;
extension: provided beyond the inventory's own surface; unsupported: raises a typed error; delegated: the engine's own
business (plans, retries, transactions, catalogs), with nothing to call; absent: no part of the vocabulary, and left to
Spark's own API.
"""

from __future__ import annotations

from skeinwork.plans import COVERS

_STATUS = {
    "builtin": "S1 S2 S3 S4 S12 S14 S16 P1 P2 P3 P4 P6 P8 P9 P13 P15 P16 P19 P23 P25 P28 P31 J1 J2 J3 J5 J6 J10 J11 J12 J13 J17 A1 A3 A4 A5 A6 A7 A8 A10 A14 A19 W3 L1 L2 L3 U1 U2 U3 U4 U5 "
    "F1 F7 F9 F10 F11 F16 F17 F24 F26 F27 M1 M4 M6 M7 M8 M9 M10 M12 M15 D2 D5 D8 D13 K1 K9 X6",
    "composed": "S5 S6 S7 S8 S9 S10 S11 S15 P5 P7 P10 P11 P12 P14 P18 P20 P21 P22 P24 P26 P27 P29 P30 J7 J8 J9 J14 J15 J16 A2 A9 A11 A12 A15 W1 W2 L4 L5 L6 L7 L8 L9 L10 U6 U7 F2 F3 F4 F5 F6 F8 F12 F13 F14 F15 F18 F19 F20 F21 "
    "F22 F23 F25 F28 F29 F30 F31 F32 M2 M3 M5 M11 M13 M14 M16 M17 M18 D1 D3 D4 D6 D7 D9 D10 D11 D12 D14 D15 D16 D17 D18 D19 D20 D21 D22 D23 D24 D25 D26 D27 D28 N4 N5 N7 N8 N9 N11 N12 N13 N14 N15 N17 G12 G13 "
    "T1 T2 T3 T4 T5 T6 T7 T8 T9 T10 X1 X2 X3 X4 X5 X7 X8 X9 X10 X12 K4 S17",
    "udf": "N1 N2 N3 N6 N10 N16 A13 G1 G2 G3 G4 G5 G6 G7 G8 G9 G11 G14 G15 G16 G17",
    "extension": "S13 A16 A17 W4 K2",
    "absent": "J4 J19 U8 M19 K3 K7 S18",
    "unsupported": "P17 G10 G18 T11 K5",
    "delegated": "J18 A18 X11 K6 K8 K10",
}

#: What raises for each unsupported row.
RAISES = {"P17": "functions.logic.compare_with_culture", "G10": "functions.spatial.relate_pattern", "G18": "functions.spatial.normalize, z_or_m", "T11": "operators.temporal.TemporalRead.write", "K5": "errors.Unsupported"}

STATUS = {i: status for status, ids in _STATUS.items() for i in ids.split()}


def capabilities() -> list[tuple[str, str, list[str]]]:
    """(id, status, queries that cover it) of every row."""
    by: dict[str, list[str]] = {}
    for name, ids in COVERS.items():
        for i in ids:
            by.setdefault(i, []).append(name)
    key = lambda i: (i[0], int(i[1:]))
    return [(i, STATUS[i], by.get(i, [])) for i in sorted(STATUS, key=key)]
