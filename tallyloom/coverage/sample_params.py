"""Report parameters that fit the sample data (FIXTURES.md)."""

from tallyloom.plans import (
    category_yoy, ci_review, curves, customer_segmentation, daily_impact, demand_accuracy, initiative_forecast,
    member_comparison, member_forecast, promise_impact, ship_order_actuals, shipment_comparison, wbr)

SCENARIO = "2001 PLAN"
AS_OF = "2001-07-01"
CREATORS = ("root", "ops")

REPORTS = {
    "report_ci_review": (ci_review, ci_review.Params(creators=CREATORS)),
    "report_category_yoy": (category_yoy, category_yoy.Params(
        scenario=SCENARIO, current_from="2000-12-31", prior_from="2000-01-02", prior_to="2000-07-02")),
    "report_customer_segmentation": (customer_segmentation, customer_segmentation.Params(
        creators=CREATORS, scenario=SCENARIO, first_year=2000, members_since="2001-01-01", shock_since="2000-01-01")),
    "report_member_forecast": (member_forecast, member_forecast.Params(
        published_since="2000-12-31", pinned_days=("2001-06-20",), previews={"20010701 preview": "s3"}, since="2000-01-01")),
    "report_daily_impact": (daily_impact, daily_impact.Params(
        scenario=SCENARIO, year=2001, forecast_of_country={"JP": 5005}, forecast_elsewhere=5006)),
    "report_demand_accuracy": (demand_accuracy, demand_accuracy.Params(
        scenario=SCENARIO, forecast_id=5006, since="2001-01-01")),
    "report_initiative_forecast": (initiative_forecast, initiative_forecast.Params(
        scenario=SCENARIO, since="2001-01-01", first_year=2001)),
    "report_promise_impact": (promise_impact, promise_impact.Params()),
    "report_curves": (curves, curves.Params(since="2001-01-01", first_day="2000-01-01", last_day="2001-12-31")),
    "report_ship_order_actuals": (ship_order_actuals, ship_order_actuals.Params(after_year=1999, before_year=2002)),
    "report_wbr": (wbr, wbr.Params(as_of=AS_OF, pinned_portfolio="20010101a", pinned_date="2001-01-01", scenario=SCENARIO)),
    "report_member_comparison": (member_comparison, member_comparison.Params(
        listed_since="2001-01-01", since="2000-01-01", shock_since="2000-01-01")),
    "report_shipment_comparison": (shipment_comparison, shipment_comparison.Params(
        listed_since="2001-01-01", since="2000-01-01")),
}
