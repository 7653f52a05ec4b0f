"""Texts, limits and ranges that results must carry unchanged."""

# Domain rules (name, column, predicate over the column read as a double).
DOMAIN_RULES = [
    ("age_out_of_range", "age", "{c} < 0 or {c} > 120"),
    ("bmi_out_of_range", "bmi", "{c} <= 0 or {c} > 90"),
    ("glucose_out_of_range", "avg_glucose_level", "{c} <= 0 or {c} > 500"),
]

# Texts a CSV field may hold for a missing value.
CSV_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Risk tiers in order of priority.
TIER_TABLE = [
    {
        "label": "critical",
        "name": "NGUY CO RAT CAO",
        "name_en": "Critical Risk",
        "color": "#DC2626",
        "priority": 1,
        "clinical_action": (
            "[KHAN CAP] Chuyen benh nhan den Khoa Than kinh / Cap cuu ngay lap tuc. "
            "Chi dinh ngay: CT nao khong can quang (hoac MRI DWI neu co), "
            "do huyet ap 2 tay, ECG 12 dao trinh, xet nghiem dong mau (PT, APTT, INR), "
            "duong huyet mao mach va dien giai do. "
            "Khong de benh nhan cho doi qua 30 phut."
        ),
        "followup": "Trong vong 30 phut - theo chuan FAST (Face, Arms, Speech, Time)",
    },
    {
        "label": "high",
        "name": "NGUY CO CAO",
        "name_en": "High Risk",
        "color": "#EA580C",
        "priority": 2,
        "clinical_action": (
            "Kham chuyen khoa Than kinh hoac Noi tim mach trong 24-48 gio. "
            "Kiem tra: huyet ap (theo doi 2 lan/ngay), duong huyet luc doi, "
            "lipid mau toan phan (LDL, HDL, Triglyceride), sieu am tim va "
            "Doppler mach mau canh neu co chi dinh. "
            "Dieu chinh phac do neu dang dieu tri tang huyet ap / dai thao duong."
        ),
        "followup": "Trong 24-48 gio",
    },
    {
        "label": "moderate",
        "name": "NGUY CO TRUNG BINH",
        "name_en": "Moderate Risk",
        "color": "#CA8A04",
        "priority": 3,
        "clinical_action": (
            "Tam soat dinh ky moi 3-6 thang tai co so y te. "
            "Tu van thay doi loi song: giam can neu BMI > 25, "
            "bo hut thuoc la, han che ruou bia, tap the duc it nhat 150 phut/tuan. "
            "Kiem soat tot huyet ap (muc tieu < 130/80 mmHg) va duong huyet. "
            "Xem xet dung aspirin neu co chi dinh tim mach tu bac si."
        ),
        "followup": "3-6 thang",
    },
    {
        "label": "low",
        "name": "NGUY CO THAP",
        "name_en": "Low Risk",
        "color": "#16A34A",
        "priority": 4,
        "clinical_action": (
            "Tam soat suc khoe dinh ky hang nam. "
            "Khuyen cao: duy tri loi song lanh manh - che do an DASH "
            "(nhieu rau, it muoi, it chat beo bao hoa), van dong thuong xuyen, "
            "khong hut thuoc, kiem soat cang thang. "
            "Tai kham ngay neu xuat hien trieu chung dot ngot: meo mieng, "
            "yeu liet tay/chan, noi kho, nhin mo, dau dau du doi."
        ),
        "followup": "12 thang",
    },
]

# Tier cut-offs used when none are given, in order of priority.
DEFAULT_TIER_CUTS = [0.15, 0.05, 0.01, 0.0]

# Boosted tree settings used when none are given.
BOOSTING_DEFAULTS = {
    "n_estimators": 400,
    "max_depth": 4,
    "learning_rate": 0.05,
    "min_child_weight": 2.0,
    "subsample": 0.9,
    "colsample_bytree": 0.9,
    "gamma": 0.0,
    "reg_alpha": 0.0,
    "reg_lambda": 1.0,
    "scale_pos_weight": 19.0,
}

# Search ranges (name, kind, low, high).
TREE_SEARCH_SPACE = [
    ("n_estimators", "int", 150, 900),
    ("max_depth", "int", 3, 8),
    ("learning_rate", "log", 1e-3, 0.2),
    ("min_child_weight", "float", 1.0, 12.0),
    ("subsample", "float", 0.6, 1.0),
    ("colsample_bytree", "float", 0.6, 1.0),
    ("gamma", "float", 0.0, 8.0),
    ("reg_alpha", "log", 1e-8, 5.0),
    ("reg_lambda", "log", 1e-3, 20.0),
    ("scale_pos_weight", "float", 5.0, 25.0),
]
ALLKNN_SEARCH_SPACE = [
    ("allknn_n_neighbors", "int", 3, 7),
    ("allknn_kind_sel", "choice", "mode", "all"),
]
NCR_SEARCH_SPACE = [
    ("ncr_n_neighbors", "int", 3, 7),
    ("ncr_threshold_cleaning", "float", 0.5, 1.0),
]

# Threshold grid.
GRID_START, GRID_STOP, GRID_POINTS = 0.001, 0.99, 200
