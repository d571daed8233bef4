"""The result tables of the ad job."""

from __future__ import annotations

from dataclasses import dataclass

from clickloom.sinks.keyed import ADD, INSERT, OVERWRITE, REPLACE_GROUP, KeyedTable

# Columns of the result tables.
USER_CLICKS = "date string, userid bigint, adid bigint, clickCount bigint"
BLACKLIST = "userid bigint"
STAT = "date string, province string, city string, adid bigint, clickCount bigint"
TOP3 = "date string, province string, adid bigint, clickCount bigint"
TREND = "date string, hour string, minute string, adid bigint, clickCount bigint"
HOUR_STEPS = "date string, start timestamp, adid bigint, step bigint"
ARRIVALS = "date string, pane timestamp, minute_key string, adid bigint, clicks bigint"

STAT_KEYS = ("date", "province", "city", "adid")
TREND_KEYS = ("date", "hour", "minute", "adid")


@dataclass(frozen=True)
class AdTables:
    """All tables of one ad job below a common folder. Counts get each batch's additions."""

    root: str

    @property
    def user_clicks(self) -> KeyedTable:
        keys = ("date", "userid", "adid")
        return self._table("ad_user_click_count", USER_CLICKS, keys, ADD)

    @property
    def blacklist(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/ad_blacklist", BLACKLIST, ("userid",), INSERT)

    @property
    def stat(self) -> KeyedTable:
        return self._table("ad_stat", STAT, STAT_KEYS, ADD)

    @property
    def top3(self) -> KeyedTable:
        return self._table("ad_province_top3", TOP3, ("date", "province"), REPLACE_GROUP)

    @property
    def trend(self) -> KeyedTable:
        return self._table("ad_click_trend", TREND, TREND_KEYS, ADD)

    @property
    def hour_steps(self) -> KeyedTable:
        keys = ("date", "start", "adid")
        return KeyedTable(f"{self.root}/ad_hour_steps", HOUR_STEPS, keys, ADD, "step", "date")

    @property
    def arrivals(self) -> KeyedTable:
        """Panes of the sliding hour by arrival; their date is that of the arrival."""
        keys = ("date", "pane", "minute_key", "adid")
        return KeyedTable(f"{self.root}/ad_arrivals", ARRIVALS, keys, ADD, "clicks", "date")

    @property
    def running_stat(self) -> KeyedTable:
        """The counts that a stream with state puts out: the last one of a key holds."""
        return self._table("ad_running_stat", STAT, STAT_KEYS, OVERWRITE)

    def all(self) -> list[KeyedTable]:
        return [self.user_clicks, self.blacklist, self.stat, self.top3, self.trend]

    def _table(self, name: str, columns: str, keys: tuple[str, ...], rule: str) -> KeyedTable:
        return KeyedTable(f"{self.root}/{name}", columns, keys, rule, "clickCount", "date")
