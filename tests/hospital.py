"""Hand-made daily batches in the seven extracts' layout."""

from __future__ import annotations

from datetime import date
from pathlib import Path

from wardhouse.contracts import TABLES

DAY1, DAY2 = date(2026, 4, 29), date(2026, 4, 30)


def write_extract(root, day: date, name: str, rows, header=None) -> Path:
    folder = Path(root) / f"BDD_HOSPITAL_{day:%Y%m%d}"
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{name}_{day:%Y%m%d}.txt"
    names = TABLES[name].header if header is None else header
    lines = [";".join(names), *rows]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return path


def rooms(n=787):
    return [f"{i};R{i:03d};{i % 5};A;Type {i % 3 + 1};{10 + i % 4 * 5};1999-03-01" for i in range(n)]


JOBS = ("Generaliste", "Chirurgien", "Dermatologiste", "Dentiste", "Cardiologue")


def staff(day: date, n=20):
    return [
        f"{i};Name{i};First{i};{JOBS[i % 5]};{day} 08:00:00;{day} 18:00:00;Fin de journée;"
        "1999-03-01;2024-02-23;Actif"
        for i in range(n)
    ]


MEDICATIONS = [
    "M1;Aspirin;box;PAIN;BRAND_A",
    "M1;Zaspirin;box;PAIN;BRAND_A",
    "M2;;bottle;COUGH;BRAND_B",
    "M3;Named;bottle;COUGH;BRAND_B",
    "M3;;bottle;COUGH;BRAND_B",
    ";Nameless;box;PAIN;BRAND_A",
]

PATIENTS = {
    DAY1: [
        "1;Un;A;1980-05-10;Lyon;FR;111;+33;0600000001;1;Rue A;;69001;Lyon;FR;2026-01-01 00:00:00;2026-04-01 00:00:00",
        "2;Deux;B;2000-02-29;Nice;FR;222;+33;;;;;;;;2026-01-01;2026-04-01",
        "3;Trois;C;;;;;;;;;;;Paris;FR;2026-01-01;2026-04-01",
        "0;Zero;Z;;;;;;;;;;;;;2026-01-01;2026-04-01",
    ],
    DAY2: [
        "1;Un-bis;A;1980-05-10;Lyon;FR;111;+33;0600000009;1;Rue A;;69001;Lyon;FR;2026-01-01 00:00:00;2026-04-29 10:00:00",
        "2;Old;B;2000-02-29;Nice;FR;222;+33;;;;;;;;2026-01-01;2026-03-01",
        "3;Same;C;;;;;;;;;;;Paris;FR;2026-01-01;2026-04-01",
        "4;Quatre;D;1990-01-01;;;;;;;;;;;;2026-04-29;2026-04-29",
        "5;Cinq;;1990-01-01;;;;;;;;;;;;2026-04-29;",
    ],
}

CONSULTATIONS = {
    DAY1: [
        "1;1;1;2026-04-29 09:00:00;2026-04-29 09:30:30;70;38;C;12;Grippe;True;1;False",
        "2;2;2;2026-04-29 10:00:00;2026-04-29 10:00:00;60;100;F;13;Angine;False;2;True",
        "3;3;3;2026-04-29 11:00:00;2026-04-29 10:00:00;60;37;C;13;Angine;False;;True",
        "4;4;1;2026-04-29 11:00:00;;60;37;C;13;Grippe;maybe;;False",
        "5;5;2;2026-04-29 12:59:59;2026-04-29 13:00:01;60;37;K;13;;on;3;0",
    ],
    DAY2: [
        "6;1;4;2026-04-30 09:00:00;2026-04-30 09:45:00;80;37;C;12;Grippe;False;4;True",
        "2;2;2;2026-04-29 10:00:00;2026-04-29 10:10:00;61;99;F;13;Angine;False;2;True",
    ],
}

TREATMENTS = {
    DAY1: [
        "1;M1;PAIN;BRAND_A;3;1 par jour;1;2026-04-29 09:30:00",
        "2;M2;COUGH;BRAND_B;;2 par jour;2;2026-04-29 10:00:00",
        "3;M9;PAIN;BRAND_A;5;1 par jour;5;2026-04-29 12:00:00",
        "4;M3;COUGH;BRAND_B;2;;4;2026-04-29 12:00:00",
    ],
    DAY2: ["4;M3;COUGH;BRAND_B;7;matin;6;2026-04-30 09:40:00"],
}

STAYS = {
    DAY1: [
        "1;2;101;2026-04-29 22:59:00;2026-04-30 06:00:00;350.50;2",
        "2;2;0;2026-04-29 23:45:00;2026-04-30 00:30:00;10;2",
        "3;2;102;2026-04-29 09:00:00;2026-04-29 18:00:00;;3",
        "4;3;103;2026-04-29 10:00:00;2026-04-28 10:00:00;5;3",
        "5;3;103;2026-04-29 10:00:00;;-1;3",
    ],
    DAY2: ["6;6;104;2026-04-30 10:00:00;;;1"],
}


def write_batch(root, day: date) -> None:
    write_extract(root, day, "PATIENT", PATIENTS[day])
    write_extract(root, day, "PERSONNEL", staff(day))
    write_extract(root, day, "CHAMBRE", rooms())
    write_extract(root, day, "MEDICAMENT", MEDICATIONS)
    write_extract(root, day, "CONSULTATION", CONSULTATIONS[day])
    write_extract(root, day, "TRAITEMENT", TREATMENTS[day])
    write_extract(root, day, "HOSPITALISATION", STAYS[day])
