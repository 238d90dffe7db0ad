"""Fixed schemas: candles, stored features, stream events."""

from __future__ import annotations

CANDLE = (
    "time timestamp_ntz, symbol string, open double, high double, low double, close double, volume double, close_time timestamp_ntz, "
    "quote_volume double, number_of_trades bigint, taker_buy_base_volume double, taker_buy_quote_volume double, source string, ingested_at string"
)
BASE_CANDLE = "time timestamp_ntz, symbol string, open double, high double, low double, close double, volume double, source string, ingested_at string"

_LEVELS = "array<struct<price: double, qtty: bigint>>"
_DAY_PRICES = "highestPrice double, lowestPrice double, openPrice double, tradingSessionId int"
_BAR = "resolution string, open double, high double, low double, close double, volume bigint, type string, lastUpdated bigint"
_MONEY = "decimal(38,10)"
#: Stream events by name, with their wire codes and payload fields as the wire names them.
EVENTS: dict[str, tuple[list[str], str]] = {
    "trade": (["t"], f"matchPrice double, matchQtty bigint, totalVolumeTraded bigint, grossTradeAmount double, {_DAY_PRICES}"),
    "trade_extra": (["te"], f"matchPrice double, matchQtty bigint, side int, avgPrice double, totalVolumeTraded bigint, grossTradeAmount double, {_DAY_PRICES}"),
    "expected_price": (["e"], "closePrice double, expectedTradePrice double, expectedTradeQuantity bigint"),
    "security_definition": (["sd"], "productGrpId string, securityGroupId string, basicPrice double, ceilingPrice double, floorPrice double, openInterestQuantity bigint, securityStatus string, "
                            "symbolAdminStatusCode string, symbolTradingMethodStatusCode string, symbolTradingSanctionStatusCode string, finalTradeDate string, listingDate string"),
    "quote": (["q"], f"bid {_LEVELS}, offer {_LEVELS}, totalOfferQtty bigint, totalBidQtty bigint"),
    "ohlc": (["b"], _BAR),
    "ohlc_closed": (["bc"], _BAR),
    "order_event": (["do", "eo"], "id string, side string, accountNo string, price double, priceSecure double, averagePrice double, quantity bigint, fillQuantity bigint, canceledQuantity bigint, "
                    "leaveQuantity bigint, orderType string, orderStatus string, loanPackageId bigint, marketType string, transDate string, createdDate string, modifiedDate string"),
    "position": (["p"], f"quantity bigint, averagePrice {_MONEY}, marketValue {_MONEY}, costBasis {_MONEY}, unrealizedPl {_MONEY}, unrealizedPlPercent {_MONEY}, timestamp bigint"),
    "market_index": (["mi"], "indexName string, changedRatio double, changedValue double, fluctuationSteadinessIssueCount bigint, fluctuationDownIssueCount bigint, fluctuationUpIssueCount bigint, "
                     "lowestValueIndexes double, highestValueIndexes double, priorValueIndexes double, valueIndexes double, grossTradeAmount double, totalVolumeTraded bigint, "
                     "marketIndexClass string, currencyCode string, indexTypeCode string, tradingSessionId int, transactTime string"),
    "account": (["a"], f"cash {_MONEY}, buyingPower {_MONEY}, portfolioValue {_MONEY}, equity {_MONEY}, timestamp bigint"),
    "foreign": (["f"], "transactTime string, foreignInvestorTypeCode string, sellVolume bigint, sellTradedAmount double, buyVolume bigint, buyTradedAmount double, totalSellVolume bigint, "
                "totalSellTradedAmount double, totalBuyVolume bigint, totalBuyTradedAmount double, foreignerOrderLimitQuantity bigint, foreignerBuyPossibleQuantity bigint"),
}
COMMON_EVENT = "T string, symbol string, marketId string, boardId string, isin string, time string"
