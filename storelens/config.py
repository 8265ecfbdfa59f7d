"""Settings of the plans. Defaults are the reference values of each operator."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Weight of each candidate logic in the final list.
LOGIC_WEIGHTS = {
    "bestseller_overall": 0.05,
    "bestseller_category": 0.10,
    "bestseller_brand": 0.08,
    "browsing_history": 0.18,
    "cart_favorite": 0.18,
    "repurchase": 0.12,
    "item_cooccurrence": 0.12,
    "basket_association": 0.10,
    "attribute_fit": 0.07,
    "rfm_stage": 0.05,
    "ml_purchase_probability": 0.25,
    "user_based_cf": 0.10,
    "attribute_similarity": 0.08,
    "time_seasonality": 0.05,
    "bandit_optimization": 0.10,
}


@dataclass(frozen=True)
class LogicConfig:
    """One candidate logic: whose key, how many, how far back."""

    enabled: bool = True
    key_column: str = "member_id"
    top_n: int = 10
    lookback_days: int = 30
    tz: str = "Asia/Tokyo"

    def but(self, **changes):
        return replace(self, **changes)

    @property
    def window(self) -> str:
        return f"-{self.lookback_days}d"


@dataclass(frozen=True)
class BestsellerConfig(LogicConfig):
    half_life_days: float = 14.0


@dataclass(frozen=True)
class BrowsingConfig(LogicConfig):
    key_column: str = "cookie"
    lookback_days: int = 7


@dataclass(frozen=True)
class RepurchaseConfig(LogicConfig):
    lookback_days: int = 365
    min_purchase_count: int = 2


@dataclass(frozen=True)
class CooccurrenceConfig(LogicConfig):
    lookback_days: int = 180
    min_cooccurrence_count: int = 5
    partners: int = 5


@dataclass(frozen=True)
class BasketConfig(LogicConfig):
    lookback_days: int = 180
    min_support_count: int = 5
    min_lift: float = 1.2


@dataclass(frozen=True)
class RfmConfig(LogicConfig):
    lookback_days: int = 365


@dataclass(frozen=True)
class ProbabilityConfig(LogicConfig):
    enabled: bool = False
    lookback_days: int = 90
    #: 0 keeps the reference label (a purchase in the feature window)
    prediction_window_days: int = 0
    max_iter: int = 20
    seed: int = 42


@dataclass(frozen=True)
class UserCfConfig(LogicConfig):
    lookback_days: int = 90
    n_factors: int = 50
    n_epochs: int = 20
    min_interactions: float = 1.0
    seed: int = 42
    min_common_products: int = 3
    max_similar_users: int = 20


@dataclass(frozen=True)
class SimilarityConfig(LogicConfig):
    price_band_tolerance: float = 0.2


@dataclass(frozen=True)
class SeasonConfig(LogicConfig):
    lookback_days: int = 365
    active_days: int = 30
    season_categories: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "spring": ("101", "102"),
            "summer": ("201", "202"),
            "autumn": ("301", "302"),
            "winter": ("401", "402"),
        }
    )


@dataclass(frozen=True)
class BanditConfig(LogicConfig):
    enabled: bool = False
    active_days: int = 30
    epsilon: float = 0.2
    min_impressions: int = 100
    seed: int = 42


@dataclass(frozen=True)
class FinalConfig:
    top_n_per_user: int = 5
    max_per_category: int = 3
    max_per_brand: int = 2
    exclude_out_of_stock: bool = True
    exclude_purchased_within_days: int = 0
    include_key_type: bool = False
    tz: str = "Asia/Tokyo"
    weights: dict[str, float] = field(default_factory=lambda: dict(LOGIC_WEIGHTS))

    def but(self, **changes):
        return replace(self, **changes)


@dataclass(frozen=True)
class RecoConfig:
    bestseller_overall: BestsellerConfig = BestsellerConfig()
    bestseller_category: LogicConfig = LogicConfig()
    bestseller_brand: LogicConfig = LogicConfig()
    browsing_history: BrowsingConfig = BrowsingConfig()
    cart_favorite: LogicConfig = LogicConfig()
    repurchase: RepurchaseConfig = RepurchaseConfig()
    item_cooccurrence: CooccurrenceConfig = CooccurrenceConfig()
    basket_association: BasketConfig = BasketConfig()
    attribute_fit: LogicConfig = LogicConfig()
    rfm_stage: RfmConfig = RfmConfig()
    ml_purchase_probability: ProbabilityConfig = ProbabilityConfig()
    user_based_cf: UserCfConfig = UserCfConfig()
    attribute_similarity: SimilarityConfig = SimilarityConfig()
    time_seasonality: SeasonConfig = field(default_factory=SeasonConfig)
    bandit_optimization: BanditConfig = BanditConfig()
    final: FinalConfig = field(default_factory=FinalConfig)

    def but(self, **changes):
        return replace(self, **changes)


@dataclass(frozen=True)
class CartConfig:
    """Cart-abandonment detection and its mails."""

    tz: str = "Asia/Tokyo"
    media_name: str = "customer_site"
    window: str = "0d/now"
    session_gap_seconds: int = 1800
    idle_minutes: int = 20
    slice_seconds: int = 60
    cart_path: str = "/cart"
    max_items: int = 4
    purchase_hours: int = 48
    order_window: str = "-3d/now"
    history_window: str = "-90d/now"
    excluded_users: tuple[str, ...] = ()
    brand: str = "main"
    cart_mails_per_day: int = 1
    mails_per_day: int = 2
    rolling_cap: bool = False
    compact_slots: bool = False
    cart_url: str = "https://example.com/cart"
    home_url: str = "https://example.com/"
    coupon_expiry_date: str = "2026-08-31"
    coupon_expiry_label: str = "2026年8月31日(月) 23:59まで"
    # Coupon code, picture and text by purchase segment.
    coupon_codes: dict[str, str] = field(
        default_factory=lambda: {
            "unknown": "<COUPON_CODE_UNKNOWN>",
            "f0": "<COUPON_CODE_F0>",
            "f1": "<COUPON_CODE_F1>",
            "f3plus": "<COUPON_CODE_F3PLUS>",
        }
    )
    coupon_images: dict[str, str] = field(default_factory=lambda: {"f0": "<COUPON_IMAGE_URL_F0>"})
    coupon_image_default: str = "<COUPON_IMAGE_URL_DEFAULT>"
    coupon_texts: dict[str, str] = field(
        default_factory=lambda: {
            "unknown": "オンライン限定 5,500円(税込)以上で使える500円クーポン",
            "f0": "オンライン限定 11,000円(税込)以上で使える1,000円クーポン",
            "f1": "オンライン限定 5,500円(税込)以上で使える500円クーポン",
            "f3plus": "オンライン限定 5,500円(税込)以上で使える500円クーポン",
        }
    )
    send_type: str = "cart_abandon"
    workflow_name: str = "cart_abandonment"
    template_event_id: str = "cart_abandonment_email"
    template_id: str = "<TEMPLATE_ID>"

    def but(self, **changes):
        return replace(self, **changes)


@dataclass(frozen=True)
class UtmTags:
    source: str
    medium: str
    campaign_suffix: str


@dataclass(frozen=True)
class FeedConfig:
    """Product feeds for the advertising channels."""

    tz: str = "Asia/Tokyo"
    timezone_offset: str = "+09:00"
    store_id: str = "store-1"
    stock_location_id: str = "loc-1"
    country_code: str = "JP"
    currency_code: str = "JPY"
    shipping_value: str = "JP:::0 JPY"
    default_gender: str = "unisex"
    product_url_prefix: str = "https://shop.example.com"
    image_url_prefix: str = "https://img.example.com"
    normal_minimum_stock: int = 1
    size_type_keyword: str = "small"
    default_size_type: str = "regular"
    matched_size_type: str = "petite"
    size_system: str = "JP"
    age_group: str = "adult"
    condition: str = "new"
    free_shipping_label: str = "free"
    minimum_stock: int = 0
    dynamic_start_datetime: str = "20230101000000"
    collection_min_year: int = 20
    organic_min_year: int = 20
    free_shipping_threshold: int = 5000
    utm: dict[str, UtmTags] = field(
        default_factory=lambda: {
            "meta_organic": UtmTags("meta", "organic", "org"),
            "meta_dynamic": UtmTags("meta", "cpc", "dyn"),
            "meta_collection": UtmTags("meta", "cpc", "col"),
        }
    )

    def but(self, **changes):
        return replace(self, **changes)
