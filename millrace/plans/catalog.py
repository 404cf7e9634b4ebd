"""The question families of five business domains, with a value for every parameter."""

from __future__ import annotations

from .families import TODAY, Family, Join, distinct, percent, total


def inner(table: str, on: str, alias: str = "") -> Join:
    return Join(table, on, "inner", alias)


def anti(table: str, on: str, key: str, alias: str = "") -> Join:
    return Join(table, on, "anti", alias, key)


def left(table: str, on: str, alias: str = "") -> Join:
    return Join(table, on, "left", alias)


OPEN = "('New', 'InProgress', 'PendingCustomer')"
IN_SLA = "support_cases.resolved_at <= support_cases.sla_due_at"

# ---- customer relations

_case_account = inner("accounts", "support_cases.account_id = accounts.account_id")
_contact_account = inner("accounts", "contacts.account_id = accounts.account_id")
_case_contact = inner("contacts", "support_cases.contact_id = contacts.contact_id")
_touch_contact = inner("contacts", "interactions.contact_id = contacts.contact_id")
_touch_campaign = inner("campaigns", "interactions.campaign_id = campaigns.campaign_id")

CRM = (
    Family("crm:T1-01", "Total budget of campaigns of a type", "campaigns", where="campaigns.campaign_type = :campaign_type", measure=total("campaigns.budget_amount", 2), params={"campaign_type": "Awareness"}),
    Family("crm:T1-02", "Campaigns in a state", "campaigns", where="campaigns.status = :campaign_status", params={"campaign_status": "Active"}),
    Family("crm:T1-03", "Support cases of a priority", "support_cases", where="support_cases.priority = :priority", params={"priority": "High"}),
    Family("crm:T1-04", "Support cases of a category", "support_cases", where="support_cases.category = :category", params={"category": "Billing"}),
    Family("crm:T1-05", "Interactions of a type", "interactions", where="interactions.engagement_type = :engagement_type", params={"engagement_type": "Meeting"}),
    Family("crm:T1-06", "Accounts of a region", "accounts", where="accounts.region = :region", params={"region": "South"}),
    Family("crm:T1-07", "Cases of a priority resolved in time", "support_cases", where=f"support_cases.priority = :priority AND support_cases.resolved_at IS NOT NULL AND {IN_SLA}", params={"priority": "Critical"}),
    Family("crm:T2-01", "Cases of a region's accounts", "support_cases", (_case_account,), "accounts.region = :region", params={"region": "North"}),
    Family("crm:T2-02", "Tier with most cases of a priority", "support_cases", (_case_account,), "support_cases.priority = :priority", by=("accounts.customer_tier",), top=1, params={"priority": "High"}),
    Family("crm:T2-03", "Contacts of an industry's accounts", "contacts", (_contact_account,), "accounts.industry = :industry", params={"industry": "Retail"}),
    Family("crm:T2-04", "Interactions of a campaign type", "interactions", (_touch_campaign,), "campaigns.campaign_type = :campaign_type", params={"campaign_type": "Nurture"}),
    Family("crm:T2-05", "Directions of interactions of active or inactive contacts", "interactions", (_touch_contact,), "contacts.is_active = :is_active", by=("interactions.direction",), params={"is_active": True}),
    Family("crm:T2-06", "Accounts with most interactions of a type", "interactions", (inner("accounts", "interactions.account_id = accounts.account_id"),), "interactions.engagement_type = :engagement_type", by=("accounts.account_name", "accounts.account_id"), top=5, params={"engagement_type": "PhoneCall"}),
    Family("crm:T2-07", "Interactions on a channel with contacts of a title", "interactions", (_touch_contact,), "interactions.channel = :channel AND contacts.title = :title", params={"channel": "Email", "title": "IT Director"}),
    Family("crm:T2-08", "Part of an industry's cases resolved in time", "support_cases", (_case_account,), "accounts.industry = :industry", percent(IN_SLA), params={"industry": "Energy"}),
    Family("crm:T3-01", "A region's accounts without contacts", "accounts", (anti("contacts", "contacts.account_id = accounts.account_id", "contact_id"),), "accounts.region = :region", params={"region": "East"}),
    Family("crm:T3-02", "An industry's accounts without contacts", "accounts", (anti("contacts", "contacts.account_id = accounts.account_id", "contact_id"),), "accounts.industry = :industry", params={"industry": "Technology"}),
    Family("crm:T3-03", "Contacts of a title without interactions", "contacts", (anti("interactions", "interactions.contact_id = contacts.contact_id", "interaction_id"),), "contacts.title = :title", params={"title": "Business Analyst"}),
    Family("crm:T3-04", "Contacts of a title in no campaign", "contacts", (anti("contact_campaigns", "contact_campaigns.contact_id = contacts.contact_id", "campaign_id"),), "contacts.title = :title", params={"title": "Program Manager"}),
    Family("crm:T3-05", "Campaigns of a type without interactions", "campaigns", (anti("interactions", "interactions.campaign_id = campaigns.campaign_id", "interaction_id"),), "campaigns.campaign_type = :campaign_type", params={"campaign_type": "Retention"}),
    Family("crm:T3-06", "Campaigns in a state without interactions", "campaigns", (anti("interactions", "interactions.campaign_id = campaigns.campaign_id", "interaction_id"),), "campaigns.status = :campaign_status", params={"campaign_status": "Draft"}),
    Family("crm:T4-01", "A region's engagement points by channel", "interactions", (_touch_contact, _contact_account), "accounts.region = :region", total("interactions.engagement_points"), ("interactions.channel",), params={"region": "West"}),
    Family("crm:T4-02", "Cases of an industry's contacts by priority", "support_cases", (_case_contact, _contact_account), "accounts.industry = :industry", by=("support_cases.priority",), params={"industry": "Healthcare"}),
    Family("crm:T4-03", "Part of a tier's cases resolved in time by category", "support_cases", (_case_contact, _contact_account), "accounts.customer_tier = :customer_tier", percent(IN_SLA), ("support_cases.category",), params={"customer_tier": "Strategic"}),
    Family("crm:T4-04", "Attribution weight of a campaign type by title", "campaigns", (inner("contact_campaigns", "contact_campaigns.campaign_id = campaigns.campaign_id"), inner("contacts", "contact_campaigns.contact_id = contacts.contact_id")), "campaigns.campaign_type = :campaign_type", total("contact_campaigns.attribution_weight", 4), ("contacts.title",), params={"campaign_type": "Awareness"}),
    Family("crm:T4-05", "Cases of a region's contacts by status", "support_cases", (_case_contact, _contact_account), "accounts.region = :region", by=("support_cases.status",), params={"region": "Central"}),
    Family("crm:T4-06", "An industry's engagement points by type", "interactions", (_touch_contact, _contact_account), "accounts.industry = :industry", total("interactions.engagement_points"), ("interactions.engagement_type",), params={"industry": "Manufacturing"}),
    Family("crm:T5-01", "Campaign types with most engagement points in a region", "interactions", (_touch_campaign, _touch_contact, _contact_account), "accounts.region = :region", total("interactions.engagement_points"), ("campaigns.campaign_type",), top=3, params={"region": "South"}),
    Family("crm:T5-02", "Accounts with most open cases of a category", "support_cases", (_case_account,), f"support_cases.category = :category AND support_cases.status IN {OPEN}", by=("accounts.account_name", "accounts.account_id"), top=5, params={"category": "Access"}),
    Family("crm:T5-04", "A region's engagement points from quarter to quarter", "interactions", (_touch_contact, _contact_account), "accounts.region = :region", periods=("interactions.interaction_at", "interactions.engagement_points"), params={"region": "North"}),
    Family("crm:T5-05", "Region with the best trend of a tier", "interactions", (_touch_contact, _contact_account), "accounts.customer_tier = :customer_tier", by=("accounts.region",), periods=("interactions.interaction_at", "interactions.engagement_points"), top=1, params={"customer_tier": "Preferred"}),
)

# ---- sales

_deal_lead = inner("leads", "deals.lead_id = leads.lead_id")
_quote_product = inner("products", "quotations.product_id = products.product_id")
_quote_deal = inner("deals", "quotations.deal_id = deals.deal_id")

#: Exact in both engines: cents times whole percents.
_NET = "CAST(quotations.quantity AS DECIMAL(9,0)) * CAST(quotations.unit_price AS DECIMAL(12,2)) * CAST(100 - quotations.discount_pct AS DECIMAL(5,2)) * CAST(0.01 AS DECIMAL(3,2))"
_WON = "deals.rep_name = targets.rep_name AND deals.stage = 'Won' AND deals.close_date >= targets.period_start AND deals.close_date < targets.period_end"

SALES = (
    Family("sales:T1-01", "Amount of deals in a stage", "deals", where="deals.stage = :stage", measure=total("deals.deal_amount", 2), params={"stage": "Won"}),
    Family("sales:T1-02", "Leads in a status", "leads", where="leads.lead_status = :lead_status", params={"lead_status": "Qualified"}),
    Family("sales:T1-03", "Leads of a source", "leads", where="leads.lead_source = :lead_source", params={"lead_source": "Referral"}),
    Family("sales:T1-04", "Active or inactive products", "products", where="products.is_active = :is_active", params={"is_active": False}),
    Family("sales:T1-05", "Quotation lines in a status", "quotations", where="quotations.quote_status = :quote_status", params={"quote_status": "Sent"}),
    Family("sales:T2-01", "Deals from a source's leads", "deals", (_deal_lead,), "leads.lead_source = :lead_source", params={"lead_source": "WebForm"}),
    Family("sales:T2-02", "Source with most deals in a stage", "deals", (_deal_lead,), "deals.stage = :stage", by=("leads.lead_source",), top=1, params={"stage": "Lost"}),
    Family("sales:T2-03", "Quoted quantity of a category", "quotations", (_quote_product,), "products.category = :category", total("quotations.quantity"), params={"category": "Hardware"}),
    Family("sales:T2-04", "Quotation lines of deals in a stage", "quotations", (_quote_deal,), "deals.stage = :stage", params={"stage": "Negotiation"}),
    Family("sales:T2-05", "Quote statuses of a category", "quotations", (_quote_product,), "products.category = :category", by=("quotations.quote_status",), params={"category": "Services"}),
    Family("sales:T2-06", "Category with the most quoted value in a status", "quotations", (_quote_product,), "quotations.quote_status = :quote_status", total("quotations.quantity * quotations.unit_price", 2), ("products.category",), top=1, params={"quote_status": "Accepted"}),
    Family("sales:T2-07", "Deals in a stage from a territory", "deals", (_deal_lead,), "deals.stage = :stage AND leads.territory = :territory", params={"stage": "Won", "territory": "South"}),
    Family("sales:T2-08", "Part of a category's lines accepted", "quotations", (_quote_product,), "products.category = :category", percent("quotations.quote_status = 'Accepted'"), params={"category": "Software"}),
    Family("sales:T3-01", "A territory's leads without deals", "leads", (anti("deals", "deals.lead_id = leads.lead_id", "deal_id"),), "leads.territory = :territory", params={"territory": "North"}),
    Family("sales:T3-02", "Leads in a status without deals", "leads", (anti("deals", "deals.lead_id = leads.lead_id", "deal_id"),), "leads.lead_status = :lead_status", params={"lead_status": "New"}),
    Family("sales:T3-03", "A territory's targets without won deals", "targets", (anti("deals", _WON, "deal_id"),), "targets.territory = :territory", params={"territory": "East"}),
    Family("sales:T4-01", "Net revenue of deals in a stage by category", "quotations", (_quote_deal, _quote_product), "deals.stage = :stage", total(_NET, 2), ("products.category",), params={"stage": "Won"}),
    Family("sales:T4-02", "Quotation lines of a category by deal stage", "quotations", (_quote_deal, _quote_product), "products.category = :category", by=("deals.stage",), params={"category": "Subscription"}),
    Family("sales:T4-03", "Quoted deals of a source by category", "quotations", (_quote_deal, _quote_product, _deal_lead), "leads.lead_source = :lead_source", distinct("deals.deal_id"), ("products.category",), params={"lead_source": "ColdCall"}),
    Family("sales:T4-04", "A territory's won amount by target period", "targets", (left("deals", _WON),), "targets.territory = :territory", total("COALESCE(deals.deal_amount, 0)", 2), ("targets.period_start", "targets.period_end"), order="entity", params={"territory": "West"}),
    Family("sales:T5-01", "Categories with the most net revenue in a stage", "quotations", (_quote_deal, _quote_product), "deals.stage = :stage", total(_NET, 2), ("products.category",), top=3, params={"stage": "Lost"}),
    Family("sales:T5-03", "A territory's won amount from quarter to quarter", "deals", (_deal_lead,), "leads.territory = :territory AND deals.stage = 'Won'", periods=("deals.close_date", "deals.deal_amount"), digits=2, params={"territory": "Central"}),
)

# ---- finance

_entry_account = inner("accounts", "ledger_entries.account_id = accounts.account_id")
_entry_txn = inner("transactions", "ledger_entries.transaction_id = transactions.transaction_id")
_budget_account = inner("accounts", "budgets.account_id = accounts.account_id")
_RATE = "fx_rates.from_currency = transactions.source_currency AND fx_rates.to_currency = transactions.target_currency AND fx_rates.rate_date = transactions.transaction_date"
#: The amount's scale leaves the product's ten decimals whole, so it is rounded once.
_USD = "ROUND(CAST({} AS DECIMAL(18,4)) * fx_rates.rate, 4)"

FINANCE = (
    Family("finance:T1-01", "Budgeted amount of a scenario", "budgets", where="budgets.scenario = :scenario", measure=total("budgets.budget_amount", 2), params={"scenario": "Approved"}),
    Family("finance:T1-02", "Accounts of a type", "accounts", where="accounts.account_type = :account_type", params={"account_type": "Asset"}),
    Family("finance:T1-03", "Transactions of a source system", "transactions", where="transactions.source_system = :source_system", params={"source_system": "ERP"}),
    Family("finance:T1-04", "Ledger entries of a posting type", "ledger_entries", where="ledger_entries.posting_type = :posting_type", params={"posting_type": "Accrual"}),
    Family("finance:T1-05", "Rates of a source", "fx_rates", where="fx_rates.rate_source = :rate_source", params={"rate_source": "SyntheticDaily"}),
    Family("finance:T2-01", "Entries of a source system", "ledger_entries", (_entry_txn,), "transactions.source_system = :source_system", params={"source_system": "Payroll"}),
    Family("finance:T2-02", "Entries of an account type", "ledger_entries", (_entry_account,), "accounts.account_type = :account_type", params={"account_type": "Expense"}),
    Family("finance:T2-03", "Budgets of an account type", "budgets", (_budget_account,), "accounts.account_type = :account_type", params={"account_type": "Revenue"}),
    Family("finance:T2-04", "Budgeted amount of an account type", "budgets", (_budget_account,), "accounts.account_type = :account_type", total("budgets.budget_amount", 2), params={"account_type": "Expense"}),
    Family("finance:T2-05", "A currency's transactions with a rate on their day", "transactions", (inner("fx_rates", _RATE),), "transactions.source_currency = :source_currency", params={"source_currency": "EUR"}),
    Family("finance:T2-06", "A currency's amount in USD", "transactions", (inner("fx_rates", f"{_RATE} AND fx_rates.rate IS NOT NULL"),), "transactions.source_currency = :source_currency", total(_USD.format("transactions.total_amount"), 2), params={"source_currency": "GBP"}),
    Family("finance:T3-01", "A system's transactions without entries", "transactions", (anti("ledger_entries", "ledger_entries.transaction_id = transactions.transaction_id", "entry_id"),), "transactions.source_system = :source_system", params={"source_system": "Billing"}),
    Family("finance:T3-02", "A currency's transactions without entries", "transactions", (anti("ledger_entries", "ledger_entries.transaction_id = transactions.transaction_id", "entry_id"),), "transactions.source_currency = :source_currency", params={"source_currency": "USD"}),
    Family("finance:T3-03", "Root accounts of a type", "accounts", (anti("accounts", "accounts.parent_account_id = parents.account_id", "account_id", "parents"),), "accounts.account_type = :account_type", params={"account_type": "Liability"}),
    Family("finance:T3-04", "Accounts of a type with a parent", "accounts", (inner("accounts", "accounts.parent_account_id = parents.account_id", "parents"),), "accounts.account_type = :account_type", params={"account_type": "Equity"}),
    Family("finance:T3-05", "Transactions whose rate is on file but missing", "transactions", (inner("fx_rates", f"{_RATE} AND fx_rates.rate IS NULL"),)),
    Family("finance:T4-01", "A system's entries by account type", "ledger_entries", (_entry_txn, _entry_account), "transactions.source_system = :source_system", by=("accounts.account_type",), params={"source_system": "Manual"}),
    Family("finance:T4-03", "An account type's entries by system", "ledger_entries", (_entry_txn, _entry_account), "accounts.account_type = :account_type", by=("transactions.source_system",), params={"account_type": "Asset"}),
    Family("finance:T5-01", "Account types with most entries of a system", "ledger_entries", (_entry_txn, _entry_account), "transactions.source_system = :source_system", by=("accounts.account_type",), top=3, params={"source_system": "Expense"}),
    Family("finance:T5-02", "An account type's debits in USD from quarter to quarter", "ledger_entries", (_entry_account, _entry_txn, inner("fx_rates", f"{_RATE} AND fx_rates.rate IS NOT NULL")), "accounts.account_type = :account_type AND ledger_entries.debit_amount IS NOT NULL", periods=("transactions.transaction_date", _USD.format("ledger_entries.debit_amount")), digits=2, params={"account_type": "Expense"}),
)

# ---- projects

_task_project = inner("projects", "tasks.project_id = projects.project_id")
_given_task = inner("tasks", "task_resources.task_id = tasks.task_id")
_given_resource = inner("resources", "task_resources.resource_id = resources.resource_id")
_step_project = inner("projects", "milestones.project_id = projects.project_id")
_time_task = inner("tasks", "time_entries.task_id = tasks.task_id")
_time_resource = inner("resources", "time_entries.resource_id = resources.resource_id")

PROJECTS = (
    Family("project_management:T1-01", "Projects in a status", "projects", where="projects.status = :project_status", params={"project_status": "Active"}),
    Family("project_management:T1-02", "Projects of a priority", "projects", where="projects.priority = :project_priority", params={"project_priority": "High"}),
    Family("project_management:T1-03", "Tasks in a status", "tasks", where="tasks.status = :task_status", params={"task_status": "Blocked"}),
    Family("project_management:T1-04", "Milestones in a status", "milestones", where="milestones.status = :milestone_status", params={"milestone_status": "AtRisk"}),
    Family("project_management:T1-05", "Active resources", "resources", where="resources.is_active"),
    Family("project_management:T2-01", "Tasks of projects in a status", "tasks", (_task_project,), "projects.status = :project_status", params={"project_status": "Planning"}),
    Family("project_management:T2-02", "Estimated hours of a priority", "tasks", (_task_project,), "projects.priority = :project_priority", total("tasks.estimate_hours", 2), params={"project_priority": "Critical"}),
    Family("project_management:T2-03", "Assignments of tasks in a status", "task_resources", (_given_task,), "tasks.status = :task_status", params={"task_status": "Completed"}),
    Family("project_management:T2-04", "Assignments of a role", "task_resources", (_given_resource,), "resources.role = :resource_role", params={"resource_role": "Developer"}),
    Family("project_management:T2-05", "Part of milestones completed in projects of a status", "milestones", (_step_project,), "projects.status = :project_status", percent("milestones.actual_date IS NOT NULL"), params={"project_status": "Completed"}),
    Family("project_management:T2-06", "Hours logged on tasks in a status", "time_entries", (_time_task,), "tasks.status = :task_status", total("time_entries.hours", 2), params={"task_status": "InProgress"}),
    Family("project_management:T2-07", "Assignments of a department", "task_resources", (_given_resource,), "resources.department = :department", params={"department": "Quality"}),
    Family("project_management:T3-01", "Projects in a status without tasks", "projects", (anti("tasks", "tasks.project_id = projects.project_id", "task_id"),), "projects.status = :project_status", params={"project_status": "OnHold"}),
    Family("project_management:T3-02", "A role's time entries with an assignment on file", "time_entries", (inner("task_resources", "task_resources.task_id = time_entries.task_id AND task_resources.resource_id = time_entries.resource_id"), _time_resource), "resources.role = :resource_role", params={"resource_role": "QA"}),
    Family("project_management:T3-03", "Overdue tasks of projects in a status", "tasks", (_task_project,), f"projects.status = :project_status AND tasks.status <> 'Completed' AND tasks.completed_date IS NULL AND tasks.due_date < DATE '{TODAY}'", params={"project_status": "Active"}),
    Family("project_management:T3-04", "Open milestones of projects in a status", "milestones", (_step_project,), "projects.status = :project_status AND milestones.actual_date IS NULL", params={"project_status": "Active"}),
    Family("project_management:T4-01", "Assignments of tasks in a status by role", "task_resources", (_given_task, _given_resource), "tasks.status = :task_status", by=("resources.role",), params={"task_status": "NotStarted"}),
    Family("project_management:T4-02", "Hours of a priority by task status", "time_entries", (_time_task, _task_project), "projects.priority = :project_priority", total("time_entries.hours", 2), ("tasks.status",), params={"project_priority": "Low"}),
    Family("project_management:T4-03", "A role's assignments by task status", "task_resources", (_given_task, _given_resource), "resources.role = :resource_role", by=("tasks.status",), params={"resource_role": "Designer"}),
    Family("project_management:T4-04", "A department's time entries by billable status", "time_entries", (_time_resource,), "resources.department = :department", by=("CASE WHEN time_entries.billable THEN 'billable' ELSE 'non-billable' END",), params={"department": "Engineering"}),
    Family("project_management:T5-01", "Task types with most tasks in projects of a status", "tasks", (_task_project,), "projects.status = :project_status", by=("tasks.task_type",), top=3, params={"project_status": "Cancelled"}),
    Family("project_management:T5-02", "A role's hours from quarter to quarter", "time_entries", (_time_resource,), "resources.role = :resource_role", periods=("time_entries.entry_date", "time_entries.hours"), digits=2, params={"resource_role": "Analyst"}),
)

# ---- logistics

_sent_order = inner("orders", "shipments.order_id = orders.order_id")
_sent_carrier = inner("carriers", "shipments.carrier_id = carriers.carrier_id")
_stock_house = inner("warehouses", "inventory.warehouse_id = warehouses.warehouse_id")
_order_house = inner("warehouses", "orders.warehouse_id = warehouses.warehouse_id")
_no_house = anti("warehouses", "orders.warehouse_id = warehouses.warehouse_id", "warehouse_id")
_not_sent = anti("shipments", "shipments.order_id = orders.order_id", "shipment_id")

LOGISTICS = (
    Family("logistics:T1-01", "Carriers of a service level", "carriers", where="carriers.service_level = :service_level", params={"service_level": "Express"}),
    Family("logistics:T1-02", "Carriers of a type", "carriers", where="carriers.carrier_type = :carrier_type", params={"carrier_type": "Air"}),
    Family("logistics:T1-03", "Warehouses of a region", "warehouses", where="warehouses.region = :region", params={"region": "EU"}),
    Family("logistics:T1-04", "Orders of a priority", "orders", where="orders.order_priority = :order_priority", params={"order_priority": "Urgent"}),
    Family("logistics:T1-05", "Shipments in a status", "shipments", where="shipments.status = :shipment_status", params={"shipment_status": "Lost"}),
    Family("logistics:T2-01", "Shipments of orders in a status", "shipments", (_sent_order,), "orders.status = :order_status", params={"order_status": "Delivered"}),
    Family("logistics:T2-02", "Shipments of a service level", "shipments", (_sent_carrier,), "carriers.service_level = :service_level", params={"service_level": "Overnight"}),
    Family("logistics:T2-03", "Shipping cost of a carrier type", "shipments", (_sent_carrier,), "carriers.carrier_type = :carrier_type", total("shipments.shipping_cost", 2), params={"carrier_type": "Rail"}),
    Family("logistics:T2-04", "Inventory of a region", "inventory", (_stock_house,), "warehouses.region = :region", params={"region": "APAC"}),
    Family("logistics:T2-05", "Orders with a valid warehouse in a region", "orders", (_order_house,), "warehouses.region = :region", params={"region": "NA"}),
    Family("logistics:T2-06", "Orders with a shipment in a status", "shipments", (_sent_order,), "shipments.status = :shipment_status", distinct("orders.order_id"), params={"shipment_status": "Failed"}),
    Family("logistics:T3-01", "Orders in a status without a valid warehouse", "orders", (_no_house,), "orders.status = :order_status", params={"order_status": "Pending"}),
    Family("logistics:T3-02", "Orders of a priority without a valid warehouse", "orders", (_no_house,), "orders.order_priority = :order_priority", params={"order_priority": "Low"}),
    Family("logistics:T3-03", "Orders of a priority never shipped", "orders", (_not_sent,), "orders.order_priority = :order_priority", params={"order_priority": "Medium"}),
    Family("logistics:T3-04", "Orders in a status never shipped", "orders", (_not_sent,), "orders.status = :unshippable_status", params={"unshippable_status": "Cancelled"}),
    Family("logistics:T3-05", "Orders with an orphaned warehouse", "orders", (_no_house,), "orders.warehouse_id IS NOT NULL"),
    Family("logistics:T4-01", "Shipments of orders in a status by carrier type", "shipments", (_sent_order, _sent_carrier), "orders.status = :order_status", by=("carriers.carrier_type",), params={"order_status": "Shipped"}),
    Family("logistics:T4-02", "Shipments of a carrier type by order status", "shipments", (_sent_order, _sent_carrier), "carriers.carrier_type = :carrier_type", by=("orders.status",), params={"carrier_type": "Parcel"}),
    Family("logistics:T4-03", "Stock of a region by category", "inventory", (_stock_house,), "warehouses.region = :region", total("inventory.quantity_on_hand"), ("inventory.product_category",), params={"region": "LATAM"}),
    Family("logistics:T4-04", "Orders of a region's warehouses by status", "orders", (_order_house,), "warehouses.region = :region", by=("orders.status",), params={"region": "EU"}),
    Family("logistics:T5-01", "Carrier types with most shipments of orders in a status", "shipments", (_sent_order, _sent_carrier), "orders.status = :order_status", by=("carriers.carrier_type",), top=3, params={"order_status": "Returned"}),
    Family("logistics:T5-02", "Order value of a region from quarter to quarter", "orders", (_order_house,), "warehouses.region = :region", periods=("orders.order_date", "orders.total_amount"), digits=2, params={"region": "NA"}),
)

FAMILIES: dict[str, Family] = {f.id: f for f in (*CRM, *SALES, *FINANCE, *PROJECTS, *LOGISTICS)}

