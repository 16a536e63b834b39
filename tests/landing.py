"""A small hand-made landing zone: every rule has at least one row that breaks it."""

import json

MASTERS = {
    "customers_orgs": """org_id,org_name,industry,hq_region,plan_tier,is_enterprise,signup_date,sales_rep,lifecycle_stage,marketing_source,nps_score
o1, Acme ,Retail,US_East,Pro,True,2024-01-05,Ann,Active,Ads,8.5
o2,Beta,Energy,EU_West,Free, true ,2024-02-30,Bob,Churned,Web,
o2,Beta,Energy,EU_West,Free, true ,2024-02-30,Bob,Churned,Web,
o3,   ,Energy,eu-west,Free,yes,,Bob,Churned,Web,abc
,Nobody,Energy,eu-west,Free,1,,Bob,Churned,Web,1
""",
    "users": """user_id,org_id,email,role,active,created_at,last_login
u1,o1,A@X.COM,Admin,True,2024-01-01,2024-02-01
u2,o1,b@x.com,Dev,False,2024-01-01,
u3,o2,c@x.com,Dev,true,bad,
u4,o9,d@x.com,Dev,true,2024-01-01,
u5,,e@x.com,Dev,true,2024-01-01,
,o1,f@x.com,Dev,true,2024-01-01,
""",
    "billing_monthly": """invoice_id,org_id,month,subtotal,credits,taxes,currency,exchange_rate_to_usd
i1,o1,2025-07-01,100.0,10.0,5.0,USD,
i2,o1,2025-07-01,200.0,,,EUR,1.1
i3,o1,2025-07-01,,1.0,1.0,EUR,1.1
i4,o2,2025-08-01,50.0,0,1.0,EUR,2.0
i5,o9,2025-08-01,50.0,0,1.0,EUR,2.0
""",
    "resources": """resource_id,org_id,service,region,created_at,state,tags_json
r1,o1,Computing,US_East,2024-01-01,Running,"{""a"": 1}"
r2,o2,AI,eu-west,2024-01-01,Stopped,
r3,o1,mainframe,moon,2024-01-01,Running,
r4,o9,storage,us-east,2024-01-01,Running,
""",
    "support_tickets": """ticket_id,org_id,category,severity,created_at,resolved_at,csat,sla_breached
t1,o1,Bug,High,2025-08-10,2025-08-11,4.0,True
t2,o1,Bug,high,2025-08-10,,,False
t3,o1,Bug,Low,2025-08-12,,5,false
t4,o2,Bug,High,2025-07-01,,,True
t5,o9,Bug,High,2025-07-01,,,True
""",
    "marketing_touches": """touch_id,org_id,campaign,channel,timestamp,clicked,converted
m1,o1,Summer,Email,2025-08-01 10:00:00,True,False
m2,o1,Summer,email,2025-08-01T23:59:59,True,True
m3,o1,Summer,Ads,2025-08-02 00:00:00,False,False
m4,o9,Summer,Ads,2025-08-02 00:00:00,False,False
""",
    "nps_surveys": """org_id,survey_date,nps_score,comment
o1,2025-08-01,9,Great
o1,2025-08-02,,Fine
o2,2025-08-01,3,
o2,bad,3,
o9,2025-08-01,3,
""",
}


def event(event_id, timestamp="2025-08-10T10:00:00", **fields):
    row = {
        "event_id": event_id,
        "timestamp": timestamp,
        "org_id": "o1",
        "resource_id": "r1",
        "service": "compute",
        "region": "us-east",
        "metric": "requests",
        "value": 10.0,
        "unit": "count",
        "cost_usd_increment": 1.0,
        "schema_version": 2,
        "carbon_kg": 0.5,
        "genai_tokens": 0,
    }
    row.update(fields)
    return {k: v for k, v in row.items() if v is not None}


FIRST = [
    event("e1"),
    event("e2", value="109.0", metric=" CPU_Hours "),
    event("e3", schema_version=1, carbon_kg=None, genai_tokens=None),
    event("e4", resource_id="r2", org_id="o2", genai_tokens=7),
    event("e5", unit=None),
    event("e6", cost_usd_increment=-0.5),
    event("e7", timestamp="not a time"),
    event("e8", resource_id=None, service="Quantum"),
    event("e9", resource_id=None, region="Moon"),
    event("e10", org_id="o77"),
    event("e11", resource_id="r77"),
    event("e12", timestamp="2025-08-12T00:05:01"),
    event("e13", timestamp="2025-08-12T00:05:00"),
    event(None),
    event(None),
    event("e14", resource_id="r3"),
    event("e15", cost_usd_increment=-0.01),
    event("e16", cost_usd_increment=-0.9, unit=None, region="Moon", resource_id=None),
    event("e17", value=None, unit=None),
]
SECOND = [
    event("e1"),
    event("e18", timestamp="2025-07-20T00:00:00", metric="storage_gb_hours"),
    event("e19", resource_id=None, service="genai", genai_tokens=0),
    event("e20", resource_id=None, service="storage", genai_tokens=5),
]


def write_landing(root):
    """Write CSVs and the first event file."""
    landing = root / "landing"
    (landing / "usage_events_stream").mkdir(parents=True)
    for name, text in MASTERS.items():
        (landing / f"{name}.csv").write_text(text)
    add_events(root, "part-1", FIRST)


def add_events(root, name, events):
    folder = root / "landing" / "usage_events_stream"
    (folder / f"{name}.jsonl").write_text("".join(json.dumps(e) + "\n" for e in events))
