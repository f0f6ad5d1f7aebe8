"""What a funnel and an experiment look like; every operator reads its names from here.

Nothing below is tied to one table: a different product supplies other ``Step`` rows and
other column names and gets the same models.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Step:
    """One funnel step.

    ``reached_col`` is the session column: a count of the step's events, or a boolean
    when ``as_flag`` is set. ``summary_col`` is the column of the per-variant summary
    (``None`` leaves the step out of it).
    """

    event: str
    short: str
    reached_col: str
    first_ts_col: str
    funnel_col: str
    summary_col: str | None = None
    as_flag: bool = False


@dataclass(frozen=True)
class Rate:
    """Share of sessions at ``numerator`` among those at ``denominator`` (event names).

    ``denominator=None`` means all sessions; ``complement`` turns a pass rate into a
    loss rate.
    """

    name: str
    numerator: str
    denominator: str | None
    complement: bool = False


# The ordered funnel events and the published column names.
FUNNEL_STEPS = (
    Step("view_homepage", "homepage", "homepage_views", "homepage_ts",
         "sessions_with_homepage_view", "sessions_homepage"),
    Step("search_product", "search", "has_searched_product", "search_ts",
         "sessions_with_product_search"),
    Step("view_product_details", "product_view", "has_viewed_product", "product_view_ts",
         "sessions_with_product_view", "sessions_product_viewed"),
    Step("add_to_cart", "add_to_cart", "added_to_cart", "add_to_cart_ts",
         "sessions_with_cart_adds", "sessions_added_to_cart"),
    Step("checkout_initiated", "checkout", "has_checkout", "checkout_initiated_ts",
         "sessions_with_checkout", "sessions_checkout", as_flag=True),
    Step("purchase_completed", "purchase", "has_purchased", "purchase_completed_ts",
         "sessions_with_purchase", "total_conversions", as_flag=True),
)

FUNNEL_RATES = (
    Rate("homepage_to_product_rate", "view_product_details", "view_homepage"),
    Rate("product_to_cart_rate", "add_to_cart", "view_product_details"),
    Rate("cart_to_checkout_rate", "checkout_initiated", "add_to_cart"),
    Rate("checkout_to_purchase_rate", "purchase_completed", "checkout_initiated"),
    Rate("cart_abandonment_rate", "checkout_initiated", "add_to_cart", complement=True),
    Rate("checkout_abandonment_rate", "purchase_completed", "checkout_initiated", complement=True),
    Rate("overall_conversion_rate", "purchase_completed", None),
)


@dataclass(frozen=True)
class FunnelSpec:
    steps: tuple[Step, ...] = FUNNEL_STEPS
    rates: tuple[Rate, ...] = FUNNEL_RATES
    event_id: str = "event_id"
    event_type: str = "event_type"
    event_ts: str = "event_timestamp"
    session: str = "session_id"
    user: str = "user_id"
    variant: str = "variant"
    device: str = "device"
    channel: str = "acquisition_channel"
    signup: str = "signup_date"

    @property
    def session_key(self) -> list[str]:
        return [self.session, self.user, self.variant, self.device]

    @property
    def segment(self) -> list[str]:
        return [self.device, self.variant, self.channel, "user_type"]

    @property
    def hops(self) -> list[tuple[Step, Step, str]]:
        """Consecutive step pairs with the name of their gap column."""
        return [
            (a, b, f"{a.short}_to_{b.short}_seconds")
            for a, b in zip(self.steps, self.steps[1:])
        ]

    def step(self, event: str) -> Step:
        for s in self.steps:
            if s.event == event:
                return s
        raise KeyError(f"no funnel step named {event!r}")


@dataclass(frozen=True)
class ExperimentSpec:
    control: str = "control"
    treatment: str = "new_checkout_ui"
    outcome: str = "has_purchased"
    covariates: tuple[str, ...] = ("device", "acquisition_channel")
    srm_alpha: float = 0.01
    balance_alpha: float = 0.05
    checkout_event: str = "checkout_initiated"
    relative_mde: float = 0.10
    baseline_rate: float = 0.05


@dataclass(frozen=True)
class Domains:
    """Accepted values per column (fixed values), used by the data tests."""

    variant: tuple[str, ...] = ("control", "new_checkout_ui")
    device: tuple[str, ...] = ("desktop", "mobile", "tablet")
    acquisition_channel: tuple[str, ...] = ("Organic", "Google_Ads", "Email", "Direct")
    user_type: tuple[str, ...] = ("new_user", "returning_user")
    grain: tuple[str, ...] = ("segment_level", "variant_level")
    event_type: tuple[str, ...] = field(
        default_factory=lambda: tuple(s.event for s in FUNNEL_STEPS)
    )


DEFAULT_FUNNEL = FunnelSpec()
DEFAULT_EXPERIMENT = ExperimentSpec()
DEFAULT_DOMAINS = Domains()
