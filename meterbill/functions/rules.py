"""Rule sets and labels of the billing reports.

A rule set names the dimension values the reports select on: which realty
species are multi-flat or private houses, which service names are cold or hot
water, which reading channels count as self-service, which tariff plans are
zero-rated.  The production values are text in the billing database; the
fixture values pick the equivalent rows of the stand-in views.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    multi_flat_species: tuple[str, ...]
    private_species: tuple[str, ...]
    # house section: LIKE patterns, OR-ed, case-sensitive
    cold_service: tuple[str, ...]
    hot_service_house: tuple[str, ...]
    # meter section: LIKE patterns, OR-ed, case-sensitive (differs from houses)
    hot_service_meter: tuple[str, ...]
    reading_channels: tuple[str, ...]
    corporate_channels: tuple[str, ...]
    zero_tariff: str
    individual_user_type: str
    stormwater_service: str
    inspector_code: str
    inspector_name: str
    stormwater_code: str
    attribute_type: str


# ---------------------------------------------------------------------------
# These must equal the original billing job's text exactly.
# ---------------------------------------------------------------------------
PRODUCTION = Rules(
    multi_flat_species=("Квартира в МКД", "Комната", "Комната в общежитии", "МКД"),
    private_species=("Частный дом", "Квартира в ЧД"),
    cold_service=("Водоснабжение%",),
    hot_service_house=("ГВС%", "Горячее водоснабжение%", "Холодная вода для ГВС%",
                       "Холодная вода для приготовления горячей%"),
    hot_service_meter=("%ГВС%", "%Горяч%"),
    reading_channels=("Личный кабинет РКЦ", "Заведено через ЛК", "Телеграмм-бот РКЦ",
                      "Голосовой бот РКЦ"),
    corporate_channels=("Личный кабинет РКЦ",),
    zero_tariff="%улев%",
    individual_user_type="Физическое лицо",
    stormwater_service="Ливневые стоки",
    inspector_code="NLC846169",
    inspector_name="Контролеры",
    stormwater_code="LIVN",
    attribute_type="Характеристики объекта недвижимости",
)

# Report row labels, in report order (seq 1..26; seq 7 is one row per channel).
REPORT_LABELS = (
    (1, "Отчет-статистика"),
    (2, "'====== Общая статистика ======"),
    (3, "Открытых ЛС всего"),
    (4, "Действующих договоров всего"),
    (5, "'====== Переданные показания счетчиков через ЛК ======"),
    (6, "ФЛ (кол-во ЛС) (Всего, через все каналы)"),
    (7, "ФЛ, "),
    (8, "ЮЛ (кол-во договоров)"),
    (9, "'====== Статистика (Дома) ======"),
    (10, "Количество МКД"),
    (11, "Количество МКД со счетчиками ХВС"),
    (12, "Количество МКД со счетчиками ГВС"),
    (13, "Количество частных домов"),
    (14, "Количество частных домов со счетчиками ХВС"),
    (15, "Количество частных домов со счетчиками ГВС"),
    (16, "'====== Статистика (ИПУ) ======"),
    (17, "'---=== ХВС ===---"),
    (18, "Количество счетчиков ХВС"),
    (19, "Количество счетчиков ХВС в МКД"),
    (20, "Количество ЛС со счетчиками ХВС"),
    (21, "Количество ЛС услугой ХВС"),
    (22, "'---=== ГВС ===---"),
    (23, "Количество счетчиков ГВС"),
    (24, "Количество счетчиков ГВС в МКД"),
    (25, "Количество ЛС со счетчиками ГВС"),
    (26, "Количество ЛС услугой ГВС"),
)

# Meter extract column names, in output order.
EXTRACT_COLUMNS = (
    "№ договора", "Наименование юр.лица", "Тип объекта", "Полный адрес", "Тип пользователя",
    "Контролер", "Счетчик (модель)", "Серийный № счетчика", "Услуга", "Объем", "Показания",
    "Дата приема показаний", "Источник показаний",
)
# ---------------------------------------------------------------------------

# Rows of the stand-in views that play the same roles (FIXTURES.md).
FIXTURE = Rules(
    multi_flat_species=("HOUSEHOLD", "BUILDING"),
    private_species=("FURNITURE", "MACHINERY"),
    cold_service=("cold%",),
    hot_service_house=("hot%", "red g%"),
    hot_service_meter=("%hot%", "%gizmo%"),
    reading_channels=("AF", "NO", "RF", "RO"),
    corporate_channels=("AF",),
    zero_tariff="%ROM%",
    individual_user_type="HOUSEHOLD",
    stormwater_service="old rod",
    inspector_code="VIEW",
    inspector_name="view",
    stormwater_code="CLICK",
    attribute_type="object",
)

SECTION_SEQS = frozenset({2, 5, 9, 16, 17, 22})
